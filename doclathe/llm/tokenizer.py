"""Byte-level BPE encoding of whole corpora: numpy merge rounds over the distinct words of a batch."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from itertools import batched

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doclathe.runtime import spread

#: Where the rank file lies by default.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the public pattern that splits a text into words before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters of text that are split and merged at once; bounds a task's memory.
CHARS = 4_000_000


class Ranks:
    """A vocabulary as arrays: the id of each byte, and the mergeable pairs of ids, sorted, with the id that each makes.

    Ids are ranks, so the pair with the least result is merged first. The pair that makes a token is found by merging the token's own bytes with
    the ranks below it, which leaves two parts."""

    def __init__(self, lines: bytes):
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines())}
        self.byte = np.array([table[bytes([i])] for i in range(256)], np.int64)
        pairs = []
        for token, rank in table.items():
            if len(token) > 1:
                parts = [token[i : i + 1] for i in range(len(token))]
                while len(parts) > 2:
                    best, at = min((table.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
                    if best >= rank:
                        break
                    parts[at : at + 2] = [parts[at] + parts[at + 1]]
                if len(parts) == 2:
                    pairs.append((table[parts[0]] << 32 | table[parts[1]], rank))
        keys = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.keys, self.made = keys[:, 0].copy(), keys[:, 1].copy()

    def merge(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rounds over many words in one flat array: in each, every word merges its lowest-ranked pair wherever that pair stands."""
        none = np.int64(1) << 40
        done_s, done_w = [], []
        while len(symbols):
            key = symbols[:-1] << 32 | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where((self.keys[at] == key) & (word[:-1] == word[1:]), self.made[at], none)
            rank = np.r_[rank, none]
            start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            low = np.minimum.reduceat(rank, start)
            size = np.diff(np.r_[start, len(word)])
            least = np.repeat(low, size)
            final = least == none
            if final.any():
                done_s.append(symbols[final])
                done_w.append(word[final])
                symbols, word, rank, least = (x[~final] for x in (symbols, word, rank, least))
                if not len(symbols):
                    break
            hit = rank == least
            # of a run of overlapping hits (a a a) the 1st, 3rd, ... are merged
            i = np.flatnonzero(hit)
            run = np.cumsum(np.r_[True, np.diff(i) != 1]) - 1
            first = np.flatnonzero(np.r_[True, np.diff(run) != 0])
            i = i[(np.arange(len(i)) - first[run]) % 2 == 0]
            symbols = symbols.copy()
            symbols[i] = rank[i]
            keep = np.ones(len(symbols), bool)
            keep[i + 1] = False
            symbols, word = symbols[keep], word[keep]
        s, w = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (done_s, done_w))
        order = np.argsort(w, kind="stable")
        return s[order], w[order]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends): the ids of all words after each other, and where each word's ids end."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        flat = self.byte[np.frombuffer(b"".join(raw), np.uint8)]
        ids, word = self.merge(flat, np.repeat(np.arange(len(raw)), size))
        return ids, np.cumsum(np.bincount(word, minlength=len(raw)))


@lru_cache(maxsize=4)
def _ranks(lines: bytes) -> Ranks:
    return Ranks(lines)


_split = regex.compile(PATTERN)


def encode_batch(ranks: Ranks, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of the texts. Null and empty texts have no ids. Each distinct word of the batch is merged once."""
    if len(texts) == 1 and texts[0] and len(texts[0]) > CHARS:  # one very long text: its words by the million
        parts = [_encode(ranks, [list(w)])[0].astype(np.int32) for w in batched((m.group() for m in _split.finditer(texts[0])), CHARS // 4)]
        ids = np.concatenate(parts)
        return ids, np.array([0, len(ids)])
    return _encode(ranks, [_split.findall(t) if t else [] for t in texts])


def _encode(ranks: Ranks, found: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    count = np.fromiter(map(len, found), np.int64, len(found))
    flat = pa.array([w for f in found for w in f], pa.string()) if count.sum() else pa.array([], pa.string())
    coded = flat.dictionary_encode()
    code = coded.indices.to_numpy()
    ids, ends = ranks.encode_words(coded.dictionary.to_pylist())
    begin = np.r_[0, ends[:-1]] if len(ends) else np.zeros(0, np.int64)
    size = (ends - begin)[code] if len(code) else np.zeros(0, np.int64)
    total = np.r_[0, np.cumsum(size)]
    out = ids[np.arange(total[-1]) - np.repeat(total[:-1] - begin[code], size)] if len(code) else ids
    return out, total[np.r_[0, np.cumsum(count)]]


def encode(df: DataFrame, ranks: str = RANKS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): the ids of each whole text under a public byte-level BPE vocabulary, without special tokens.

    Null and empty texts give an empty list. The strings of special tokens in a text are ordinary text. The rank file is read once by the driver
    (its size is fixed: about a megabyte) and broadcast. No shuffle; a text is never cut, repeated keys and texts are fine."""
    spark = df.sparkSession
    with open(ranks, "rb") as f:
        lines = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _ranks(lines.value)
        for batch in batches:
            size = pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            long = np.flatnonzero(size > CHARS)  # each stands alone
            cuts = np.unique(np.r_[0, np.flatnonzero(np.diff(np.cumsum(size) // CHARS)) + 1, long, long + 1, batch.num_rows])
            for at, to in zip(cuts[:-1], cuts[1:]):
                part = batch.slice(at, to - at)
                ids, ends = encode_batch(own, part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))], names=[key, "ids"])

    kind = df.schema[key].dataType.simpleString()
    return spread(df.select(key, F.col(text).alias("text"))).mapInArrow(run, f"`{key}` {kind}, ids array<int>")
