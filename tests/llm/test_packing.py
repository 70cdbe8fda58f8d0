import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm import packing as P
from tessera.llm import tokens

PATH = tokens.vocabulary("word_bpe_49k.json")


def test_differencing_is_near_equal():
    sizes = np.random.default_rng(2).integers(1, 400, 500).tolist()
    window, sums = P.differencing(sizes, 20)
    assert sums.sum() == sum(sizes) and sums.max() - sums.min() <= 20
    assert np.array_equal(np.bincount(window, sizes, 20), sums)


def test_count_rises_when_capacity_is_passed():
    window = P.split([6, 6, 6], 10)
    assert len(set(window)) == 3
    assert P.split([], 10).size == 0 and set(P.split([10], 10)) == {0}


@pytest.mark.parametrize("sizes", [[1] * 50, [100] * 40, [4096, 8192, 1], [3000] * 30, [5000, 17, 4095, 64], []])
def test_packer_covers_every_id_once(sizes):
    p = P.Packer(3, capacity=4096, batch_windows=4)
    for d, n in enumerate(sizes):
        p.add(d, np.arange(n, dtype=np.uint32))
    p.end()
    seen, windows = {}, {}
    for doc, at, ids, n, seq, offset in p.take():
        assert n == sizes[doc]
        seen.setdefault(doc, []).extend(ids.tolist())
        assert ids[0] == at
        windows.setdefault(seq, []).append((offset, len(ids)))
    assert {d: sorted(v) for d, v in seen.items()} == {d: list(range(n)) for d, n in enumerate(sizes)}
    padded = 0
    for parts in windows.values():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end
            end += n
        assert end <= 4096
        padded += 0 if end & (end - 1) == 0 else 4096 - end
    assert padded <= 0.02 * sum(sizes) + 64


def test_ids_are_the_tokenizer_s(spark, make_docs, odd_rows):
    strange = odd_rows + [(20, "it's <|endoftext|> we'll  go on é 　ñ 123 a b\x0bc", "en")]
    got = P.pack(make_docs(strange), PATH).collect()
    t = Tokenizer.from_file(PATH)
    want = {}
    for i, text, _ in strange:
        want.setdefault(i, []).append([*t.encode(text or "", add_special_tokens=False).ids, 2])
    single = [i for i, v in want.items() if len(v) == 1]
    for i in single:
        parts = sorted((r["start"], np.frombuffer(r["ids"], "<u4").tolist()) for r in got if r["doc_id"] == i)
        assert sum((p for _, p in parts), []) == want[i][0]
        assert {r["doc_tokens"] for r in got if r["doc_id"] == i} == {len(want[i][0])}
    for i in set(want) - set(single):
        assert sum(r["length"] for r in got if r["doc_id"] == i) == sum(map(len, want[i]))
    assert all(r["length"] * 4 == len(r["ids"]) for r in got)
    seqs = {}
    for r in got:
        seqs[r["sequence_id"]] = seqs.get(r["sequence_id"], 0) + r["length"]
    assert max(seqs.values()) <= 4096
    assert public_tokenizers.path("word_bpe_49k.json") == PATH


def test_empty_table(spark, make_docs):
    assert P.pack(make_docs([]), PATH).count() == 0
