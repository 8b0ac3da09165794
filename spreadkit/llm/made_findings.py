"""Labelled findings made from the published shapes of credentials and of what is
taken for them, for training where no table labels findings.

Secrets stand bare, quoted or behind a name; so do the look-alikes, and the names
of credentials stand before both, so that no single feature tells them apart.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
_LETTERS = _LOWER + _UPPER + _DIGITS
# fixed values: prefixes of published key formats
PREFIXES = (
    "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "github_pat_", "glpat-", "sk-", "sk_live_", "sk_test_", "rk_live_", "AKIA", "ASIA",
    "AIza", "xoxb-", "xoxp-", "xoxa-", "eyJ", "npm_", "hf_", "dop_v1_", "shpat_", "pypi-",
)
_NAMES = "api_key token secret password auth_token access_key client_secret private_key credential key session".split()
_CHECKS = "commit revision digest checksum md5 sha256 etag build id uuid".split()


def _draw(rng: random.Random, letters: str, n: int) -> str:
    return "".join(rng.choices(letters, k=n))


def secret(rng: random.Random) -> str:
    """A value of a credential's shape that needs no name to be one."""
    body = _draw(rng, _LETTERS, rng.randrange(24, 49))
    kind = rng.randrange(8)
    if kind == 0:
        return "AKIA" + _draw(rng, _UPPER + "234567", 16)
    if kind == 1:
        return rng.choice(PREFIXES[:11]) + body
    if kind == 2:
        return "AIza" + _draw(rng, _LETTERS + "-_", 35)
    if kind == 3:
        return f"xoxb-{_draw(rng, _DIGITS, 12)}-{_draw(rng, _DIGITS, 12)}-{_draw(rng, _LETTERS, 24)}"
    if kind == 4:
        return ".".join(["eyJ" + _draw(rng, _LETTERS, 33), "eyJ" + _draw(rng, _LETTERS + "-_", rng.randrange(30, 120)), _draw(rng, _LETTERS + "-_", 43)])
    if kind == 5:
        return "\n".join(_draw(rng, _LETTERS + "+/", 64) for _ in range(rng.randrange(2, 7)))
    return _draw(rng, _LETTERS + "+/" * (kind == 6), rng.choice([32, 40, 43, 64]))


def named_secret(rng: random.Random) -> str:
    """A value that a name makes a credential."""
    kind = rng.randrange(3)
    if kind == 0:
        return _draw(rng, "0123456789abcdef", rng.choice([32, 40, 64]))
    if kind == 1:
        return _draw(rng, _LETTERS + "!$%#@.", rng.randrange(8, 24))
    return secret(rng).split("\n")[0]


def look_alike(rng: random.Random, words: list[str]) -> str:
    """A long value that is no secret."""
    hexa = lambda n: _draw(rng, "0123456789abcdef", n)
    some = rng.choices(words, k=rng.randrange(2, 5))
    kind = rng.randrange(9)
    if kind == 0:
        return "-".join(map(hexa, (8, 4, 4, 4, 12)))
    if kind == 1:
        return hexa(rng.choice([20, 32, 40, 64]))
    if kind == 2:
        return "/" + "/".join(some) + rng.choice(["", "/index.html", ".txt", f"/{hexa(20)}/index"])
    if kind == 3:
        return "https://" + rng.choice(words) + ".org/" + "/".join(some) + rng.choice(["", f"?id={rng.randrange(10**6)}", "/" + _draw(rng, _LETTERS, 20)])
    if kind == 4:
        return _draw(rng, _DIGITS, rng.randrange(16, 25))
    if kind == 5:
        return rng.choice("_-").join(some) + "_" + rng.choice(words)
    if kind == 6:
        return "".join(w.capitalize() for w in some) + rng.choice(words)
    if kind == 7:
        return f"20{rng.randrange(10, 30)}-0{rng.randrange(1, 10)}-{rng.randrange(10, 29)}T{rng.randrange(10, 24)}-{rng.randrange(10, 60)}-00"
    return rng.choice("=-_") * rng.randrange(16, 60)


def made_findings(words: list[str], n: int, seed: int) -> Iterator[tuple[str, str, int]]:
    """``n`` texts with a value each: text, value, and whether it is a secret.
    Prose around the value is drawn from ``words``."""
    rng = random.Random(seed)
    words = words or ["text", "with", "nothing", "else"]
    prose = lambda: " ".join(rng.choices(words, k=rng.randrange(3, 9)))
    quote = lambda x: rng.choice(['"{}"', "'{}'", "{}", "{}"]).format(x)
    for k in range(n):
        if k % 2:
            value = look_alike(rng, words)
            lead = rng.choice(["", "", rng.choice(_CHECKS) + " ", rng.choice(_CHECKS) + "=", "see ", rng.choice(_NAMES) + " " + rng.choice(_CHECKS) + " "])
            yield f"{prose()} {lead}{quote(value)} {prose()}", value, 0
        elif rng.random() < 0.4:
            value = named_secret(rng)
            name = rng.choice(["", "my_", "aws_", "DB_"]) + rng.choice(_NAMES)
            yield f"{prose()} {name}{rng.choice(['=', ' = ', ': ', ':'])}{quote(value)} {prose()}", value, 1
        else:
            value = secret(rng)
            pem = "-----BEGIN RSA PRIVATE KEY-----\n{}\n-----END RSA PRIVATE KEY-----" if "\n" in value else "{}"
            yield f"{prose()} {rng.choice(['', '', 'use ', rng.choice(_NAMES) + ' '])}{quote(pem.format(value))} {prose()}", value, 1
