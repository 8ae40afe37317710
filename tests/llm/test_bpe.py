import base64
import hashlib
import re

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewater.llm import bpe as B

PATH = P.path(B.MULTI)
MODEL = B.bpe(PATH)


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "\n", "x\n\n  y\t z", "it 's don't", "héé ñ日本語 🙂🙂", "a　b   c",
         "\x1c a\x1fb", "---- ----", "1234 56.7%", "<|endoftext|> x", "aaaaaaaaaaaaa " * 40, "\r\n \r\n", "é" * 500, "don't l'été a.b, c.\nD.\nÉé.\n\nE \nf\n g", " x\xa0. y", "a×b÷c. ñ-ö", "x.\u0301y z\u0301.", "a" * 3000 + " b"]


def test_ids_equal_the_rank_library(reference):
    assert [MODEL.encode(t).tolist() for t in TEXTS] == [reference.encode_ordinary(t) for t in TEXTS]
    assert [i.tolist() for i in MODEL.encode_arrow(pa.array(TEXTS))] == list(map(reference.encode_ordinary, TEXTS))


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\tab'sté日.,×\u0301\xa0\u3000"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_any_text_round_trips(reference, text):
    ids = MODEL.encode(text)
    assert ids.tolist() == reference.encode_ordinary(text)
    assert MODEL.decode_bytes(ids) == text.encode()


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("aé日🙂 "), min_size=1, max_size=30))
def test_offsets_and_spans_with_split_characters(text):
    ids, data = MODEL.encode(text), text.encode()
    start, end = MODEL.offsets(ids, data)
    at = 0
    for i, s, e in zip(ids.tolist(), start.tolist(), end.tolist()):
        n = len(MODEL.tokens[i])
        assert s == len(data[:at + 1].decode("utf-8", "ignore")) - (0 if data[:at + 1].decode("utf-8", "ignore") != data[:at + 1].decode("utf-8", "replace") else 1)
        assert data[at:at + n] in text[s:e].encode()
        at += n
    for cut in range(len(ids) + 1):
        assert MODEL.decode_span(ids, 0, cut) + MODEL.decode_span(ids, cut, len(ids)) == text


def test_equal_first_hashes_do_not_mix_parts(reference, monkeypatch):
    model = B.ByteBPE(PATH)
    plain = B._polynomials
    monkeypatch.setattr(B, "_polynomials", lambda *a: [np.zeros(len(a[1]), np.uint64) + np.uint64(6), plain(*a)[1]])
    assert [i.tolist() for i in model.encode_arrow(pa.array(TEXTS))] == list(map(reference.encode_ordinary, TEXTS))


def test_more_parts_than_the_table_holds(reference, monkeypatch):
    monkeypatch.setattr(B, "TABLE_BITS", 5)
    model = B.ByteBPE(PATH)
    many = " ".join(f"w{i}" for i in range(300))
    for batch in (["a b c d e f g h i j"], ["k l m n o p q r s t u v w x y z"], [many, "a b"], TEXTS[:3]):
        assert [i.tolist() for i in model.encode_arrow(pa.array(batch))] == list(map(reference.encode_ordinary, batch))


def test_json_vocabulary_equals_the_library():
    from tokenizers import Tokenizer
    path = P.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    special = ["a <|endoftext|> b", "<|endoftext|>", "  <|endoftext|>  x", "<|endoftext|><|endoftext|>é", "<|endoftext", "|>", "x <|endo", "ftext|>", ""]
    for texts in (TEXTS, special, special + TEXTS, [t + "<|endoftext|>" + t for t in TEXTS]):
        assert [i.tolist() for i in B.ByteBPE(path).encode_arrow(pa.array(texts))] == [tok.encode(t, add_special_tokens=False).ids for t in texts]
    model = B.bpe(path)
    assert model.encode("a <|endoftext|> b").tolist() == [64, 220, 50256, 275]
    assert model.decode_bytes(model.encode("a <|endoftext|> b")) == b"a <|endoftext|> b"


def brute(reference, rows):
    out = set()
    for d, t in rows:
        ids = reference.encode_ordinary(t or "")
        out.add((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                 hashlib.sha256((t or "").encode()).hexdigest()))
    return out


def test_query_edge_rows(spark, tmp_path, reference):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, None), (3, "a"), (3, "a"), (9, "w " * 50_000)]
    spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id LONG, text STRING, n_tokens STRING") \
        .write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r)[:4] for r in B.op2_byte_bpe(spark, str(tmp_path)).collect()]
    assert len(got) == len(rows) and set(got) == brute(reference, rows)
    spark.createDataFrame([], "doc_id LONG, text STRING").write.parquet(f"{tmp_path}/e/documents.parquet")
    assert B.op2_byte_bpe(spark, f"{tmp_path}/e").count() == 0


def test_query_over_the_given_table(spark, reference):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    assert {tuple(r)[:4] for r in B.op2_byte_bpe(spark, d).collect()} == brute(reference, rows)


def test_encode_documents_gives_ids_and_offsets(spark):
    out = B.encode_documents(spark.createDataFrame([(1, "hé llo"), (2, None)], "doc_id LONG, text STRING"), PATH).collect()
    by = {r["doc_id"]: r for r in out}
    assert by[1]["token_ids"] == MODEL.encode("hé llo").tolist() and by[1]["char_ends"][-1] == 6 and by[2]["token_ids"] == []


def test_words_after_a_space_are_told_without_a_match_each(monkeypatch, reference):
    matched = []
    monkeypatch.setattr(B, "_RUN", lambda p, run=B._RUN: matched.append(p) or run(p))
    words = [f" w{''.join(chr(97 + int(c)) for c in str(i))}é" for i in range(2000)]
    odd = [" a×b", " ×", " é÷", " ÷", " Àé", " " + "q" * 300, " " + "é" * 128, " ab́", " ñ-", " 1a", " ", " aé1"]
    text = "".join(words + odd)
    model = B.ByteBPE(PATH)
    assert model.encode(text).tolist() == reference.encode_ordinary(text)
    assert len(matched) <= 2 * len(odd)
    parts = [p.encode() for p in words + odd]
    ends = np.cumsum([len(p) for p in parts])
    kind, shown = model._words(np.frombuffer(b"".join(parts), np.uint8), np.append(0, ends[:-1]), ends)
    want = [len(p) <= B.WORD_BYTES and bool(re.fullmatch(rb" (?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+", p)) for p in parts]
    chars = B.byte_chars()
    assert [k == 2 for k in kind.tolist()] == want
    assert shown == "".join(" " + "".join(chars[b] for b in p) for p, w in zip(parts, want) if w)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aZé×÷ÀÃ1-.日 \n", max_size=6), max_size=30))
def test_parts_of_letters_and_others(reference, parts):
    MODEL._forget()
    assert MODEL.encode(" ".join(parts)).tolist() == reference.encode_ordinary(" ".join(parts))


def test_parts_seen_again_stay_in_a_full_memory(monkeypatch, reference):
    model = B.ByteBPE(PATH)
    letters = lambda i: "".join(chr(97 + int(c)) for c in str(i))
    common = [f" both{letters(i)}" for i in range(40)]
    texts = ["".join(common + [f" rare{letters(1000 * b + i)}é," for i in range(100)]) for b in range(6)]
    monkeypatch.setattr(B, "CACHE_WORDS", 300)
    new = []
    monkeypatch.setattr(model, "_encode_new", lambda d, s, e, run=model._encode_new: new.append([d[a:b] for a, b in zip(s.tolist(), e.tolist())]) or run(d, s, e))
    for t in texts + texts[-1:]:
        assert model.encode(t).tolist() == reference.encode_ordinary(t)
        assert len(model.part_starts) == len(model.part_lengths) == len(model.second) == len(model.again)
    assert sum(p.startswith(b" both") for batch in new for p in batch) == 40
    assert len(model.part_starts) < 500
