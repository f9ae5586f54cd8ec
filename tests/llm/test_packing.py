"""Power-of-two packing: exact round trip."""

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lexigrain.llm import memory, packing
from lexigrain.llm.packing import binary_pieces, pack_glosses

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("n", [0, 1, 7, 4095, 4096, 4097, 12345])
def test_pieces_cover_every_token_once(n):
    pieces = binary_pieces(n)
    at = 0
    for start, size in pieces:
        assert start == at and size & (size - 1) == 0 and 0 < size <= 4096
        at += size
    assert at == n


def test_ids_are_the_tokenizer_s(spark, prose):
    texts = [None, "", "  ", prose(1), prose(2).upper() + "!! a,b don't", "Été ΣΑΣ İ é 日本語 <|endoftext|>x \x1cy ½", "word " * 9000, "q" * 5000]
    rows = [(i, t, 7, "x") for i, t in enumerate(texts)] + [(3, texts[3], 7, "x"), (None, "a b", 7, "x")]
    df = spark.createDataFrame(rows, "key long, gloss string, length int, ids string").repartition(2)
    out = pack_glosses(df, PATH, 2).collect()
    assert len({r["sequence"] for r in out}) == len(out) and {r["offset"] for r in out} == {0}
    tokenizer = Tokenizer.from_file(PATH)
    for key, times in [(k, 2 if k == 3 else 1) for k in range(len(texts))]:
        wanted = tokenizer.encode(texts[key] or "", add_special_tokens=False).ids + [2]
        mine = sorted((r["start"], r["length"], bytes(r["ids"]), r["n_tokens"], r["bucket"]) for r in out if r["key"] == key)
        assert all(2 ** b == size and n == len(wanted) for _, size, _, n, b in mine)
        for copy in range(times):
            assert np.frombuffer(b"".join(m[2] for m in mine[copy::times]), "<u4").tolist() == wanted
    assert sum(r["length"] for r in out if r["key"] is None) == 3
    assert pack_glosses(df.where("false"), PATH, 2).collect() == []


def test_a_worker_s_memory_is_bounded(monkeypatch, prose):
    """However many words and however long a text, the tables and the words looked up together stay small; ids are the same."""
    text = " ".join(prose(seed) for seed in range(40))
    texts = [text, "a b", prose(3), "", text + " " + prose(99) + "  ", None]
    wanted = [Tokenizer.from_file(PATH).encode(t or "", add_special_tokens=False).ids for t in texts]
    monkeypatch.setattr(packing, "WORD_TABLE", 300)
    monkeypatch.setattr(packing, "BATCH_CHARS", 1000)
    monkeypatch.setattr(memory, "_kept", {})
    looked_up, split = [], packing.pc.split_pattern

    def counted(parts, *rest):
        looked_up.append(sum(map(len, parts.to_pylist())))
        return split(parts, *rest)

    monkeypatch.setattr(packing.pc, "split_pattern", counted)
    for _ in range(2):
        found = [packing.token_ids([t or ""], PATH)[0].tolist() for t in texts]
        assert found == wanted
    assert packing.token_ids([t or "" for t in texts], PATH)[4].tolist() == wanted[4]
    table = packing._word_table(PATH)
    assert len(table.newer) <= 300 and len(table.older) <= 300 and len(table.newer) + len(table.older) > 300
    assert max(looked_up) <= 2000


def test_memory_is_given_back_before_a_task_ends(spark, monkeypatch, prose):
    """Within a task, not only at its end: a partition of any size needs the memory of a few batches."""
    work = {}
    monkeypatch.setattr(packing, "lean", lambda f: work.setdefault("pieces", f))
    monkeypatch.setattr(packing, "RELEASE_CHARS", 5000)
    monkeypatch.setattr(packing, "BATCH_CHARS", 1000)
    df = spark.createDataFrame([(1, "a")], "key long, gloss string")
    pack_glosses(df, PATH, 2)
    released = []
    monkeypatch.setattr(packing, "release", lambda: released.append(1))
    batch = pa.RecordBatch.from_pydict({"key": list(range(100)), "gloss": [prose(i) for i in range(100)]})
    out = list(work["pieces"](iter([batch])))
    assert len(released) >= sum(len(prose(i)) for i in range(100)) // 10_000
    assert sum(b.num_rows for b in out) >= 100 and {k for b in out for k in b.column(0).to_pylist()} == set(range(100))
