import pyarrow as pa

from spreadkit.llm import workers
from spreadkit.llm.workers import held, lean


def test_one_object_is_held_and_other_operators_drop_it(monkeypatch):
    monkeypatch.setattr(workers, "KEPT_BYTES", 0)
    built = []
    make = lambda name: lambda: built.append(name) or name
    assert held(("a",), make("a")) == held(("a",), make("again")) == "a"
    assert held(("b",), make("b")) == "b" and list(workers._held) == [("b",)]
    batch = pa.RecordBatch.from_arrays([pa.array([1])], ["x"])
    assert list(lean(lambda b: b, ("b",))([batch])) == [batch] and workers._held
    assert list(lean(lambda b: b)([batch])) == [batch] and not workers._held
    assert built == ["a", "b"] and workers.resident() > 0
