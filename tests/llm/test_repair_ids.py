import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidewater.llm import repair_ids as R

TOK = Tokenizer.from_file(P.path(R.VOCABULARY))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=600), st.integers(0, 700), st.integers(0, 700))
def test_blocks_round_trip_and_random_access(ids, a, b):
    g = R.Grammar(R.compress(np.array(ids, np.uint32)))
    assert g.ids().tolist() == ids
    start, stop = min(a, len(ids)), min(b, len(ids))
    assert g.ids(start, stop).tolist() == ids[start:stop]
    assert int(R.symbol_lengths(g.seq, g.lengths, g.base).sum()) == len(ids)


def test_repetition_becomes_rules():
    ids = np.tile(np.arange(50, dtype=np.uint32), 4000)
    data = R.compress(ids)
    g = R.Grammar(data)
    assert len(g.rules) and len(g.seq) < len(ids) / 8 and len(data) < len(ids) and (g.ids(777, 99_000) == ids[777:99_000]).all()
    wide = np.array([70_000, 1] * 100, np.uint32)
    assert (R.Grammar(R.compress(wide)).ids() == wide).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=2, max_size=2000))
def test_frequent_pairs_are_the_most_frequent_of_their_cells(ids):
    keys, cell = R.hashed_pairs(np.array(ids, np.uint32))
    pairs, inside = R.frequent_pairs(keys, cell)
    counts = Counter(keys.tolist())
    want = [k for k, n in sorted(counts.items(), key=lambda x: (-x[1], x[0])) if n >= R.MIN_COUNT]
    where = dict(zip(keys.tolist(), cell.tolist()))
    best = {}
    for k in want:
        best.setdefault(where[k], k)
    assert pairs.tolist() == list(best.values())
    assert set(np.flatnonzero(np.isin(keys, pairs)).tolist()) <= set(inside.tolist()) and (np.diff(inside) > 0).all()


def test_places_are_not_sorted(monkeypatch):
    def values_only(ar, return_index=False, **more):
        assert not return_index or len(ar) <= R.PAIRS_PER_ROUND * 64
        return unique(ar, return_index=return_index, **more)
    ids = np.random.default_rng(1).integers(0, 40, 300_000).astype(np.uint32)
    unique = np.unique
    monkeypatch.setattr(R.np, "unique", values_only)
    assert (R.Grammar(R.compress(ids)).ids() == ids).all()


def brute(rows):
    out, start = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = TOK.encode(t or "", add_special_tokens=False).ids + [0]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_edge_rows(spark, tmp_path):
    rows = [(i * 3, f"text {i} " * (i % 9)) for i in range(200)] + [(None, "x"), (601, None), (602, "long " * 30_000), (604, "<|endoftext|>"),
                                                                   (605, "a <|endoftext|> b"), (606, " <|endoftext|><|endoftext|>\n\n<|endoftext|"), (607, "|>x <|endo"),
                                                                   (608, "ftext|> y")]
    spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id LONG, text STRING, start INT").write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(tuple(r) for r in R.op7_repair_token_ids(spark, str(tmp_path)).filter("doc_id IS NOT NULL").collect()) \
        == sorted(brute(rows)[1:])
    spark.createDataFrame([], "doc_id LONG, text STRING").write.parquet(f"{tmp_path}/e/documents.parquet")
    assert R.op7_repair_token_ids(spark, f"{tmp_path}/e").count() == 0
    same = [(1, "a b")] * 20
    spark.createDataFrame(same, "doc_id LONG, text STRING").write.parquet(f"{tmp_path}/s/documents.parquet")
    assert sorted(tuple(r) for r in R.op7_repair_token_ids(spark, f"{tmp_path}/s").collect()) == brute(same)


def test_query_over_the_given_table(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in R.op7_repair_token_ids(spark, d).collect()) == sorted(brute(rows))


def test_many_small_blocks_keep_places(spark):
    rows = [(i, f"word{i} " * (i % 50)) for i in range(300)]
    blocks = R.write_ids(spark.createDataFrame(rows, "doc_id LONG, text STRING"), P.path(R.VOCABULARY), block_ids=500)
    assert blocks.count() > 20
    got = R.placed_blocks(blocks).select("start", "doc_ids", "doc_lengths", "grammar").mapInArrow(
        R._read, "doc_id long, start long, n_tokens long, ids_crc32 long")
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)
