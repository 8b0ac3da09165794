"""Exact token ids of whole texts, each distinct unit encoded once.

A *unit* is a stretch of a text that the tokenizer provably treats on its own:
both rules below cut only where white space meets a word, which no merge, no
pre-token and no added token of the vocabulary crosses.

* ``drop``: the vocabulary drops white space. Units are the words between ASCII
  white space.
* ``keep``: byte-level vocabularies attach a space to the word after it. A unit
  is a run of ASCII white space with the word after it. A cut is made only
  behind a byte that can't end a Unicode space, since a run of white space is
  one pre-token.

Distinct units of a stretch of text are found by 64-bit hash, encoded together by
the tokenizers library, and kept with their bytes in a cache of bounded size for
the next stretch. Bytes decide: a unit whose hash is that of other bytes is
encoded on its own. The separator between units in one call is an added token,
which the library always splits off first; units that hold part of an added token
are encoded one by one.
"""

from __future__ import annotations

import json
import os

import numpy as np

from spreadkit.llm.textarrays import IS_SPACE, ragged, same_spans, span_hashes, windows, words

CACHE_BYTES = 64 << 20
STRETCH_BYTES = 2 << 20
_PIECE_BYTES = 1 << 10


def keep_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units that begin at white space behind a visible byte; see the module."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    space = IS_SPACE[data]
    cut = np.zeros(len(data), bool)
    before = data[:-1]
    firm = (before > 0x20) & (before < 0x7F)
    high = before >= 0x80
    if high.any():
        two = np.zeros(len(before), np.uint8)
        two[1:] = data[:-2]
        three = np.zeros(len(before), np.uint8)
        three[2:] = data[:-3]
        # U+0085 and U+00A0 are C2 85 and C2 A0; the other Unicode spaces
        # start with E1, E2 or E3
        odd = (two == 0xC2) | (three == 0xE1) | (three == 0xE2) | (three == 0xE3)
        firm |= high & ~odd
    cut[1:] = space[1:] & firm
    cut[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    starts = np.flatnonzero(cut)
    return starts, np.append(starts[1:], len(data)), np.searchsorted(offsets, starts, "right") - 1


class UnitEncoder:
    """Ids as ``tokenizers`` gives them with ``add_special_tokens=False``."""

    def __init__(self, path: str, rule: str, lengths_only: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = f.read()
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = json.loads(spec)["added_tokens"]
        mark = next(a for a in added if a["special"] and not (a["lstrip"] or a["rstrip"] or a["normalized"]))
        self.mark, self.mark_id = mark["content"].encode(), mark["id"]
        self.openers = sorted({a["content"].encode()[:2] for a in added})
        self.split = {"drop": words, "keep": keep_units}[rule]
        self.lengths_only = lengths_only
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.slots = np.zeros(0, np.int32)
        # by slot: the unit's bytes in body, its ids in flat
        self.body, self.flat = np.zeros(0, np.uint8), np.zeros(0, np.uint32)
        self.body_ends, self.counts, self.begins = np.zeros((3, 0), np.int32)

    def _cache_bytes(self) -> int:
        held = (self.keys, self.slots, self.body, self.flat, self.body_ends, self.counts, self.begins)
        return sum(x.nbytes for x in held)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row (none if ``lengths_only``) and each text's
        number of them."""
        ids, counts = [], np.zeros(len(offsets) - 1, np.int64)
        for i, j in windows(offsets, STRETCH_BYTES):
            lo = offsets[i]
            starts, ends, text = self.split(data[lo : offsets[j]], offsets[i : j + 1] - lo)
            # a long text is taken in stretches of whole units
            for a, b in windows(np.append(starts, ends[-1:]), STRETCH_BYTES) if len(starts) else ():
                slots = self._slots(data[lo : offsets[j]], starts[a:b], ends[a:b])
                n = self.counts[slots].astype(np.int64)
                counts[i:j] += np.bincount(text[a:b], weights=n, minlength=j - i).astype(np.int64)
                if not self.lengths_only:
                    ids.append(self.flat[ragged(self.begins[slots], n)])
        return (np.concatenate(ids) if ids else np.zeros(0, np.uint32)), counts

    def _slots(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        distinct, first, back = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if self._cache_bytes() > CACHE_BYTES:
            self._forget()
        at = np.minimum(np.searchsorted(self.keys, distinct), max(len(self.keys) - 1, 0))
        known = self.keys[at] == distinct if len(self.keys) else np.zeros(len(distinct), bool)
        new = first[~known]
        if len(new):
            slots = self._add(data, starts[new], ends[new])
            into = np.searchsorted(self.keys, distinct[~known])
            self.keys = np.insert(self.keys, into, distinct[~known])
            self.slots = np.insert(self.slots, into, slots)
            at = np.searchsorted(self.keys, distinct)
        of = self.slots[at][back]
        lengths = np.diff(self.body_ends, prepend=np.int32(0))
        held_ends = self.body_ends[of].astype(np.int64)
        same = same_spans(data, starts, ends, self.body, held_ends - lengths[of], held_ends)
        if not same.all():  # another unit has this hash
            odd = np.flatnonzero(~same)
            of[odd] = self._add(data, starts[odd], ends[odd])
        return of

    def _add(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Encode units and keep them; their slots."""
        flat, counts = self._library(data, starts, ends)
        slots = len(self.counts) + np.arange(len(starts), dtype=np.int32)
        lengths, held = ends - starts, len(self.body)
        self.body = np.concatenate([self.body, data[ragged(starts, lengths)]])
        self.body_ends = np.concatenate([self.body_ends, (held + np.cumsum(lengths)).astype(np.int32)])
        self.begins = np.concatenate([self.begins, (len(self.flat) + np.cumsum(counts) - counts).astype(np.int32)])
        self.counts = np.concatenate([self.counts, counts.astype(np.int32)])
        if not self.lengths_only:
            self.flat = np.concatenate([self.flat, flat])
        return slots

    def _library(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and numbers of ids of the units, straight from the library."""
        lengths = ends - starts
        body = data[ragged(starts, lengths)].tobytes()
        stops = np.cumsum(lengths)
        odd = np.zeros(len(starts), bool)
        for opener in self.openers:
            at = body.find(opener)
            while at >= 0:
                odd[np.searchsorted(stops, at, "right")] = True
                at = body.find(opener, at + 1)
        units = np.split(np.arange(len(starts)), np.flatnonzero(np.diff(stops // _PIECE_BYTES)) + 1)
        texts = []
        for own in units:
            texts.append(self.mark.join(b"" if odd[k] else body[stops[k] - lengths[k] : stops[k]] for k in own).decode())
        single = np.flatnonzero(odd)
        texts += [body[stops[k] - lengths[k] : stops[k]].decode() for k in single]
        got = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.zeros(len(starts), np.int64)
        flat = []
        for own, ids in zip(units, got):
            marks = np.flatnonzero(ids == self.mark_id)
            counts[own] = np.diff(np.concatenate([[-1], marks, [len(ids)]])) - 1
            flat.append(np.delete(ids, marks))
        ids = np.concatenate(flat) if flat else np.zeros(0, np.uint32)
        if len(single):
            begins = np.cumsum(counts) - counts
            alone = got[len(units) :]
            ids = np.insert(ids, np.repeat(begins[single], [len(x) for x in alone]), np.concatenate(alone))
            counts[single] = [len(x) for x in alone]
        return ids, counts
