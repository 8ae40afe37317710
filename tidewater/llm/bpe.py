"""Byte-level BPE: encoding with the tokenizers library over Arrow batches,
offsets, and decoding.

The library's model works on text in which each byte is one visible character
(``byte_chars``). A rank file lists byte strings; every pair of listed strings
whose joint string is listed becomes a merge, ordered by the joint rank, which
gives the ids of the rank file's own library. A batch is cut in its Arrow
buffer before each single space between non-spaces, where the splitting pattern
always cuts. Parts are found again by two 64-bit hashes, so each is encoded
once and remembered (a bounded memory per Python worker).

Edge cases: NULL text encodes as empty, the empty text has no ids; texts are
never cut short; equal rows give equal results; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidewater.llm.common import CACHE_WORDS, Powers, mix, released, table, text_batches, texts

MULTI = "byte_bpe_multi_50k.tiktoken"
#: Cells of the table of remembered parts, as a power of two.
TABLE_BITS = 20
#: Bytes that are hashed, and texts' bytes that are encoded, at once.
SLAB, ENCODED = 1 << 17, 1_000_000
#: Bytes of the longest word that is mapped to characters here.
WORD_BYTES = 256
# ASCII white space, the second bytes of white space after C2, and lead bytes of wide white space.
_BLANK, _BLANK2, _WIDE = (np.isin(np.arange(256), v) for v in ([*range(9, 14), *range(28, 33)], [0x85, 0xA0], [0xE1, 0xE2, 0xE3]))
_GAP, _ALPHA = (np.isin(np.arange(256), v) for v in ([10, 32], [*range(65, 91), *range(97, 123)]))
_PUNCT = np.array([33 <= c < 127 and not chr(c).isalnum() for c in range(256)])
_LETTER2 = np.array([0x80 <= c < 0xC0 and c not in (0x97, 0xB7) for c in range(256)])
_RUN = re.compile(rb"[ \n][!-~\xc3-\xdf](?:[!-~\x80-\xff]*[!-~])?").fullmatch
POWERS = tuple(map(Powers, (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)))


def _polynomials(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit hashes of each stretch of bytes; stretches follow each other
    and are taken some SLAB bytes at a time, so the powers stay short."""
    out = [np.empty(len(starts), np.uint64) for _ in POWERS]
    cuts = np.unique(np.append(np.searchsorted(starts, np.arange(0, len(data), SLAB)), len(starts)))
    for i, j in zip(cuts.tolist(), cuts[1:].tolist()):
        a, b = starts[i:j] - starts[i], ends[i:j] - starts[i]
        values = data[starts[i]:ends[j - 1]] + np.uint64(1)
        for p, h in zip(POWERS, out):
            up, down = p.upto(len(values))
            sums = np.append(np.uint64(0), np.cumsum(values * up, dtype=np.uint64))
            h[i:j] = mix((sums[b] - sums[a]) * down[a], 1) + (b - a).astype(np.uint64)
    return out


class PartNumbers:
    """hash -> number of a part: an open table of fixed size."""

    def __init__(self):
        self.keys = np.zeros(1 << TABLE_BITS, np.uint64)
        self.numbers = np.zeros(1 << TABLE_BITS, np.int32)
        self.mask = np.uint64((1 << TABLE_BITS) - 1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of the keys, -1 of unknown ones."""
        out = np.full(len(keys), -1, np.int32)
        left, at = np.arange(len(keys)), keys & self.mask
        while len(left):
            there = self.keys[at]
            same = there == keys[left]
            out[left[same]] = self.numbers[at[same]]
            on = ~same & (there != 0)
            left, at = left[on], (at[on] + np.uint64(1)) & self.mask
        return out

    def add(self, keys: np.ndarray, first: int) -> None:
        """Numbers distinct unknown keys from ``first`` on."""
        left, at = np.arange(len(keys)), keys & self.mask
        while len(left):
            free = self.keys[at] == 0
            self.keys[at[free]] = keys[left[free]]
            won = free & (self.keys[at] == keys[left])
            self.numbers[at[won]] = first + left[won]
            left, at = left[~won], (at[~won] + np.uint64(1)) & self.mask


def byte_chars() -> list[str]:
    """The visible character of each byte: itself if it prints, else the next one after 255."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 256
    for b in range(256):
        out.append(chr(b if b in shown else extra))
        extra += b not in shown
    return out


class ByteBPE:
    """Encoder and decoder for one vocabulary file (``.json`` or rank file)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a Spark task has one core
        from tokenizers import Tokenizer

        chars, self.special = byte_chars(), {}
        if path.endswith(".json"):
            self.tok = Tokenizer.from_file(path)
            self.tok.encode_special_tokens = True  # what names a special token is cut out before
            special = sorted((t.content.encode() for t in self.tok.get_added_tokens_decoder().values()), key=len, reverse=True)
            self.special = {t: self.tok.token_to_id(t.decode()) for t in special}
            back = {c: b for b, c in enumerate(chars)}
            self.tokens = {i: bytes(map(back.__getitem__, t)) for t, i in self.tok.get_vocab(False).items()}
            self.tokens |= {i: t.content.encode() for i, t in self.tok.get_added_tokens_decoder().items()}
        else:
            with open(path, "rb") as f:
                ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
            self.tokens = {r: t for t, r in ranks.items()}
            self.tok = self._from_ranks(ranks, chars)
        size = max(self.tokens) + 1
        by_id = [self.tokens.get(i, b"") for i in range(size)]
        self.lengths = np.fromiter(map(len, by_id), np.int64, size)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(by_id), np.uint8)
        self.leads = np.fromiter((t[:1] in (b" ", b"\n") for t in by_id), bool, size)
        self.merger = self._merger(self.tok)
        self.codes = np.array([ord(c) for c in chars], "<u4")
        self._forget()

    @staticmethod
    def _merger(tok):
        """The model alone, on words of byte characters between spaces."""
        from tokenizers import Tokenizer, pre_tokenizers

        out = Tokenizer(tok.model)
        out.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        return out

    @staticmethod
    def _from_ranks(ranks: dict[bytes, int], chars: list[str]):
        from tokenizers import Tokenizer, models, pre_tokenizers

        shown = lambda t: "".join(chars[b] for b in t)
        merges = []
        for t in sorted(ranks, key=ranks.get):
            cuts = [(t[:i], t[i:]) for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
            merges += sorted(cuts, key=lambda p: (max(ranks[p[0]], ranks[p[1]]), len(p[0])))
        tok = Tokenizer(models.BPE(vocab={shown(t): r for t, r in ranks.items()},
                                   merges=[(shown(a), shown(b)) for a, b in merges]))
        # The library's byte-level step splits by public_tokenizers.PATTERN.
        tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        return tok

    def _cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Starts of the parts, at places where the pattern always cuts: of each
        text, each space or line end that has no white space beside it, and ASCII
        punctuation after a letter. Characters of three bytes from E1 to E3 count
        as white space here, which some of them are, and letters are those of ASCII
        and after C3; a cut that is left out does no harm."""
        n = len(data)
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        at = np.flatnonzero(_GAP[data])
        at = at[~edge[at]]
        near = np.concatenate([np.zeros(3, np.uint8), data, np.zeros(2, np.uint8)])
        p1, p2, p3, n1, n2 = near[at + 2], near[at + 1], near[at], near[at + 4], near[at + 5]
        blank = _BLANK[p1] | ((p2 == 0xC2) & _BLANK2[p1]) | ((p1 >= 0x80) & _WIDE[p3])
        after = _BLANK[n1] | ((n1 == 0xC2) & _BLANK2[n2]) | _WIDE[n1]
        cut = np.zeros(n + 1, bool)
        cut[at[~(blank | (after & ~edge[at + 1]))]] = True
        at = np.flatnonzero(_PUNCT[data])
        p1, p2 = near[at + 2], near[at + 1]
        cut[at[_ALPHA[p1] | ((p2 == 0xC3) & _LETTER2[p1])]] = True
        cut[offsets] = True
        return np.flatnonzero(cut[:n])

    def _words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, str]:
        """Kind 2 of the parts that are a space and letters (ASCII, or two bytes from
        C3 on) of WORD_BYTES at most, 0 of the others; and the words in byte
        characters, a space before each."""
        kind = np.zeros(len(starts), np.int8)
        short = np.flatnonzero((data[starts] == 32) & (ends - starts > 1) & (ends - starts <= WORD_BYTES))
        if not len(short):
            return kind, ""
        n = (ends - starts)[short]
        upto = np.cumsum(n)
        flat = data[np.arange(int(upto[-1])) + np.repeat(starts[short] - upto + n, n)]
        # Every second byte follows a C3, and every C3 has one in its part.
        lead, second = flat == 0xC3, _LETTER2[flat]
        paired = lead[:-1] & second[1:]
        paired[upto[:-1] - 1] = False
        letter = _ALPHA[flat]
        letter[:-1] |= paired
        letter[1:] |= paired
        letter[upto - n] = True
        words = np.logical_and.reduceat(letter, upto - n)
        kind[short[words]] = 2
        flat = flat[np.repeat(words, n)]
        space = flat == 32
        to = np.arange(len(flat)) + np.cumsum(space)
        out = np.full(len(flat) + np.count_nonzero(space), 32, "<u4")
        out[to] = self.codes[flat]
        return kind, out.tobytes().decode("utf-32-le")

    def _encode_new(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> None:
        """Adds the ids of new parts to the table. Words after a space have their
        bytes mapped to characters here and are merged by the library's model; other
        parts that begin with a space or line end and have no further white space
        are encoded as one text, in both of which a part's ids begin at the token
        that begins with its first byte. The others go one by one."""
        part = lambda i: data[starts[i]:ends[i]]
        kind, shown = self._words(np.frombuffer(data, np.uint8), starts, ends)
        for i in np.flatnonzero(kind == 0).tolist():
            kind[i] = bool(_RUN(part(i)))
        runs = b"".join(map(part, np.flatnonzero(kind == 1).tolist())).decode()
        lengths, at, pieces, total = np.empty(len(kind), np.int64), np.empty(len(kind), np.int64), [], 0
        for want, tok, text in ((2, self.merger, shown), (1, self.tok, runs)):
            ids = np.array(tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            lead = np.flatnonzero(self.leads[ids])
            of = kind == want
            if len(lead) != np.count_nonzero(of):
                kind[of] = 0
                continue
            lengths[of], at[of] = np.diff(np.append(lead, len(ids))), total + lead
            pieces.append(ids)
            total += len(ids)
        alone = self.tok.encode_batch_fast([part(i).decode() for i in np.flatnonzero(kind == 0).tolist()], add_special_tokens=False)
        sizes = np.array([len(e.ids) for e in alone], np.int64)
        lengths[kind == 0], at[kind == 0] = sizes, total + np.cumsum(sizes) - sizes
        pieces.append(np.array([i for e in alone for i in e.ids], np.uint32))
        self.part_starts = np.concatenate([self.part_starts, at + len(self.part_ids)])
        self.part_lengths = np.concatenate([self.part_lengths, lengths])
        self.part_ids = np.concatenate([self.part_ids, *pieces])

    def encode_arrow(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text, unsigned 32-bit; NULL is empty."""
        if len(self.part_starts) > CACHE_WORDS or len(self.part_ids) > 6 * CACHE_WORDS:
            self._keep_used()
        held = [t or b"" for t in texts.cast(pa.binary()).to_pylist()]
        raw = b"".join(held)
        if any(t in raw for t in self.special) and any(t in h for h in held for t in self.special):
            return self._encode_special(held)
        offsets = np.append(0, np.cumsum(np.fromiter(map(len, held), np.int64, len(held))))
        if not raw:
            return [np.empty(0, np.uint32)] * len(held)
        data = np.frombuffer(raw, np.uint8)
        starts = self._cuts(data, offsets)
        ends = np.append(starts[1:], len(data))
        one, two = _polynomials(data, starts, ends)
        one |= np.uint64(1)  # 0 marks a free cell
        number = self.numbers.find(one)
        new = np.flatnonzero(number < 0)
        self.again[number[number >= 0]] = True
        if len(new):
            keys, first = np.unique(one[new], return_index=True)
            which = new[first]
            if len(self.part_starts) + len(keys) > 0.75 * (1 << TABLE_BITS):
                if not len(self.part_starts):  # one batch, of a very long text, fills the table
                    return [np.array(self.tok.encode_batch_fast([t.decode()], add_special_tokens=False)[0].ids, np.uint32) for t in held]
                self._forget()
                return self.encode_arrow(texts)
            self.numbers.add(keys, len(self.part_starts))
            self.second = np.concatenate([self.second, two[which]])
            self.again = np.append(self.again, np.zeros(len(keys), bool))
            self._encode_new(raw, starts[which], ends[which])
            number[new] = self.numbers.find(one[new])
        n = self.part_lengths[number]
        upto = np.cumsum(n)
        ids = self.part_ids[np.arange(int(upto[-1])) + np.repeat(self.part_starts[number] - upto + n, n)]
        # Tokens before each text: those of the parts before its first.
        cut = np.append(0, upto)[np.searchsorted(starts, offsets)]
        out = [ids[a:b] for a, b in zip(cut.tolist(), cut[1:].tolist())]
        if (wrong := self.second[number] != two).any():  # two parts with one first hash
            for i in np.unique(np.searchsorted(offsets, starts[wrong], "right") - 1).tolist():
                out[i] = np.array(self.tok.encode_batch_fast([held[i].decode()], add_special_tokens=False)[0].ids, np.uint32)
        return out

    def _encode_special(self, held: list[bytes]) -> list[np.ndarray]:
        """Texts that name special tokens: these give their ids, as in the library, and
        what lies between them is encoded by itself."""
        cut = re.compile(b"(" + b"|".join(map(re.escape, self.special)) + b")")
        parts = [cut.split(t) for t in held]
        plain = self.encode_arrow(pa.array([p for text in parts for p in text[::2]], pa.binary()))
        out, at = [], 0
        for text in parts:
            ids = [plain[at]]
            for i, name in enumerate(text[1::2], 1):
                ids += [np.array([self.special[name]], np.uint32), plain[at + i]]
            at += len(text) // 2 + 1
            out.append(np.concatenate(ids))
        return out

    def _keep_used(self) -> None:
        """Forgets the parts that no batch after their first one had, or all parts
        where those that stay would be more than half of what may be remembered."""
        held, kept = self.numbers, np.flatnonzero(self.again)
        second, ids, n, at = self.second[kept], self.part_ids, self.part_lengths[kept], self.part_starts[kept]
        self._forget()
        upto = np.cumsum(n)
        if not len(kept) or len(kept) > CACHE_WORDS // 2 or upto[-1] > 3 * CACHE_WORDS:
            return
        cells = np.flatnonzero(held.keys)
        keys = np.zeros(1 << TABLE_BITS, np.uint64)
        keys[held.numbers[cells]] = held.keys[cells]
        self.numbers.add(keys[kept], 0)
        self.second, self.again = second, np.zeros(len(kept), bool)
        self.part_ids = ids[np.arange(int(upto[-1])) + np.repeat(at - upto + n, n)]
        self.part_starts, self.part_lengths = upto - n, n

    def _forget(self) -> None:
        self.numbers, self.again = PartNumbers(), np.empty(0, bool)
        self.second, self.part_ids = np.empty(0, np.uint64), np.empty(0, np.uint32)
        self.part_starts, self.part_lengths = np.empty(0, np.int64), np.empty(0, np.int64)

    def encode(self, text: str) -> np.ndarray:
        return self.encode_arrow(pa.array([text.encode("utf-8", "surrogatepass")], pa.binary()))[0]

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """The byte strings of the ids, joined."""
        n = self.lengths[ids]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(self.starts[ids] - ends + n, n)
        return self.flat[at].tobytes()

    def offsets(self, ids: np.ndarray, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """First and last-plus-one character of each token in the text whose UTF-8
        bytes are ``data``; a character split between tokens belongs to each."""
        char = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80) - 1
        ends = np.cumsum(self.lengths[ids])
        return char[ends - self.lengths[ids]], char[ends - 1] + 1

    def decode_span(self, ids: np.ndarray, start: int, stop: int) -> str:
        """The whole characters whose first byte lies in tokens start to stop - 1:
        a character cut by the start is left out, one cut by the stop is completed
        from the tokens after it."""
        data = self.decode_bytes(ids[start:stop])
        lead = 0
        while lead < len(data) and data[lead] & 0xC0 == 0x80:
            lead += 1
        while stop < len(ids) and (more := self.tokens[int(ids[stop])]) and more[0] & 0xC0 == 0x80:
            rest = 0
            while rest < len(more) and more[rest] & 0xC0 == 0x80:
                rest += 1
            data += more[:rest]
            if rest < len(more):
                break
            stop += 1
        return data[lead:].decode("utf-8", "replace")


@lru_cache(maxsize=4)
def bpe(path: str) -> ByteBPE:
    """One encoder per file and Python worker."""
    return ByteBPE(path)


def encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Batches of (doc_id, text) and the ids of their texts."""
    for b in text_batches(batches, ENCODED):
        yield b, bpe(path).encode_arrow(b.column("text"))


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, token_ids, char_starts, char_ends of each document."""
    def run(batches):
        model = bpe(path)
        for b, ids in encoded(batches, path):
            spans = [model.offsets(i, t) for i, t in zip(ids, texts(b))]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32())),
                 pa.array([s for s, _ in spans], pa.list_(pa.int64())),
                 pa.array([e for _, e in spans], pa.list_(pa.int64()))],
                names=["doc_id", "token_ids", "char_starts", "char_ends"])
    return docs.select("doc_id", "text").mapInArrow(
        released(run), "doc_id long, token_ids array<int>, char_starts array<long>, char_ends array<long>")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Digests of each document's ids and of the bytes that they decode to, and
    the number of tokens that begin or end inside a character."""
    def run(batches):
        model = bpe(path)
        for b, batch in encoded(batches, path):
            rows = []
            for d, ids in zip(b.column("doc_id").to_pylist(), batch):
                data = model.decode_bytes(ids)
                start, end = model.offsets(ids, data) if len(ids) else (ids, ids)
                split = int(np.count_nonzero(start[1:] < end[:-1]))
                rows.append((d, len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(data).hexdigest(), split))
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()))],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_split_chars"])
    return docs.select("doc_id", "text").mapInArrow(
        released(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_split_chars long")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes and decodes every document; no shuffle."""
    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(MULTI))
