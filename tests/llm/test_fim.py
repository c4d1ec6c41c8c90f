"""Fill-in-the-middle against string slicing."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import fim
from tessera.llm.fim import MARKERS, fill_in_middle, gather, restore_middle, scatter

from .conftest import got, rows


def written(text, form, a, b):
    p, m, s = text[:a], text[a:b], text[b:]
    return [text, f"<P>{p}<S>{s}<M>{m}", f"<S>{s}<P>{p}<M>{m}"][form]


@pytest.mark.parametrize("window", [1, 7, 64, 1 << 20])
def test_scatter_and_gather(monkeypatch, window):
    """Parts of any length, characters of one to four bytes, pieces of markers, windows that cut characters."""
    monkeypatch.setattr(fim, "WINDOW", window)
    rng = random.Random(window)
    for _ in range(60):
        texts = ["".join(rng.choice("aé日😀<>PSM \n\0") for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 6))]
        a = np.array([rng.randint(0, len(t)) for t in texts])
        b = np.array([rng.randint(x, len(t)) for x, t in zip(a, texts)])
        form = np.array([0 if any(m in t for m in MARKERS) else rng.randint(0, 2) for t in texts])
        out = scatter(pa.array(texts), form, a, b)
        assert out.to_pylist() == [written(*x) for x in zip(texts, form, a, b)]
        assert gather(out, form).to_pylist() == texts


def plain_row(doc_id, text):
    """The contract, written plainly."""
    t = text or ""
    x = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(t) + 1), h[1] % (len(t) + 1)))
    form = 0 if not t or any(m in t for m in MARKERS) or h[2] % 100 >= 90 else 2 if h[3] % 100 < 20 else 1
    return doc_id, len(t), ["plain", "psm", "spm"][form], *((a, b - a) if form else (None, None)), written(t, form, a, b), t


def test_rows(spark, odd, none, monkeypatch):
    out = got(restore_middle(fill_in_middle(odd)))
    key = lambda r: tuple((v is not None, v if v is not None else 0) for v in r)
    assert out == sorted((plain_row(r[0], r[1]) for r in rows()), key=key)
    assert restore_middle(fill_in_middle(none)).collect() == []
    texts = ["x<P>y", "<S>", "<M", "<" * 50, "日本" * 40, None, ""] * 30
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: tuple(r) for r in restore_middle(fill_in_middle(docs)).collect()}
    assert out == {i: plain_row(i, t) for i, t in enumerate(texts)}
    assert {r[2] for r in out.values()} == {"plain", "psm", "spm"}


def test_slices_are_bounded(monkeypatch):
    monkeypatch.setattr(fim, "SLICE", 10)
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * n for n in (3, 3, 3, 30, 1, 0, 12)])], names=["t"])
    assert [s.num_rows for s in fim._slices(batch, 0)] == [3, 1, 2, 1]
