"""Near-duplicate texts: banded minhashes, sequential Bayesian pruning of candidates, exact verification, components."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache, partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doclathe.llm.words import hashes, mix, occurrence, one_permutation, words
from doclathe.operators.components import components
from doclathe.runtime import BROADCAST_ROWS, drop_shuffles, materialize, release, small, spread

_U = np.uint64
#: Share of common words (repeats counted) from which two texts are near-duplicates: twice the common over the sum.
SIMILARITY = 0.8
#: A candidate is dropped when the chance that its similarity reaches the threshold is below this.
MISS = 0.002
#: Bands: of each of PERMUTATIONS so many, each of WIDTH minhashes of words; neighbouring words play no part, as order doesn't count. Of pairs of
#: 100-word texts at a similarity of 0.80, in order or not, at least 96 % are found. They are shuffled in PASSES of BANDS each.
PERMUTATIONS, WIDTH, PASSES, BANDS = 3, 6, 6, 5
#: 64-bit batches of one-bit minhashes that the rows of a bucket are compared by, one after another; in large buckets the first of them at once.
BATCHES, FIRST = 3, 2
#: 64-bit words of a text's parity sketch: bit b is set if an odd number of its words fall on b, so two sketches differ where words do that only one text has.
PARITY = 8
#: Rows of one bucket up to which none is let go; rows that are certainly near a row before one is let go on its account; candidates kept of a row let go.
BLOCK, FOLLOW, KEPT = 512, 16, 4
#: Rows of a bucket up to which its pairs are formed gap by gap, together with those of other buckets; rows added to a larger bucket at once, and compared with so many at once.
GAPS, STEP, TILE = 24, 1024, 128
#: Rows of a thinned bucket outside its largest class, and rows of any class, that one task compares.
CHUNK, PART = 16384, 65536

_ROW = pa.schema([("id", pa.int64()), ("bag_a", pa.int64()), ("bag_b", pa.int64()), ("n", pa.int32()), *((f"s{i}", pa.int64()) for i in range(BATCHES)), ("odd", pa.binary()), *((f"keys{p}", pa.list_(pa.int64())) for p in range(PASSES))])
_BAND = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("n", pa.int32()), *((f"s{i}", pa.int64()) for i in range(BATCHES)), ("odd", pa.binary())])
_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_SKETCH = (*(f"s{i}" for i in range(BATCHES)), "odd")
_SKETCH_TYPES = ", ".join([*(f"s{i} long" for i in range(BATCHES)), "odd binary"])


def _packed(odd: np.ndarray) -> pa.Array:
    ends = np.arange(0, 8 * PARITY * len(odd) + 1, 8 * PARITY, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), len(odd), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(odd))])


def _unpacked(odd: pa.Array) -> np.ndarray:
    if not len(odd):
        return np.zeros((0, PARITY), _U)
    start = int(np.frombuffer(odd.buffers()[1], np.int32, 1, 4 * odd.offset)[0])
    return np.frombuffer(odd.buffers()[2], _U, len(odd) * PARITY, start).reshape(-1, PARITY)


def _combine(parts: np.ndarray, seed: int) -> np.ndarray:
    out = np.full(parts.shape[0], seed, _U)
    for i in range(parts.shape[1]):
        out = mix(out * _U(0x9E3779B97F4A7C15) + parts[:, i])
    return out


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        doc, code, vocabulary = words(texts)
        count = np.bincount(doc, minlength=len(ids)) if len(doc) else np.zeros(len(ids), np.int64)
        at = np.flatnonzero(count)  # texts without words are left out
        if not len(at):
            continue
        doc, n = (np.cumsum(count > 0) - 1)[doc], len(at)
        word = hashes(vocabulary)[code]
        token = mix(word + occurrence(doc, code).astype(_U) * _U(0x9E3779B97F4A7C15))
        bag_a, bag_b = np.zeros(n, _U), np.zeros(n, _U)
        np.add.at(bag_a, doc, mix(token))
        np.add.at(bag_b, doc, mix(token ^ _U(0x5851F42D4C957F2D)))
        at_bit = mix(token ^ _U(0x2545F4914F6CDD1D))
        odd = np.zeros(n * PARITY, _U)
        np.bitwise_xor.at(odd, doc * PARITY + (at_bit >> _U(40)).astype(np.int64) % PARITY, _U(1) << (at_bit & _U(63)))
        bag = [one_permutation(doc, token, n, s) for s in range(PERMUTATIONS + BATCHES)]
        each = PASSES * BANDS // PERMUTATIONS
        keys = [_combine(bag[p][:, WIDTH * i : WIDTH * (i + 1)], each * p + i) for p in range(PERMUTATIONS) for i in range(each)]
        bits = [((b & _U(1)) << np.arange(64, dtype=_U)).sum(axis=1, dtype=_U) for b in bag[PERMUTATIONS:]]
        ends = pa.array(np.arange(0, n * BANDS + 1, BANDS, dtype=np.int32))
        lists = [pa.ListArray.from_arrays(ends, pa.array(np.stack(keys[at : at + BANDS], axis=1).view(np.int64).ravel())) for at in range(0, len(keys), BANDS)]
        yield pa.RecordBatch.from_arrays(
            [ids.take(pa.array(at)).cast(pa.int64()), pa.array(bag_a.view(np.int64)), pa.array(bag_b.view(np.int64)), pa.array(count[at].astype(np.int32)), *(pa.array(b.view(np.int64)) for b in bits), _packed(odd.reshape(n, PARITY)), *lists],
            schema=_ROW,
        )


def bounds(jaccard: float, miss: float, batches: int = BATCHES, sure: float = 0.999) -> tuple[list[int], int]:
    """(least, certain): after batch i, fewer than least[i] equal bits make a Jaccard similarity of `jaccard` less likely than `miss`, with a
    uniform prior; from `certain` equal bits after all batches it is likelier than `sure`. One-bit minhashes agree with probability (1 + J) / 2."""
    grid = (np.arange(2000) + 0.5) / 2000
    p = (1 + grid) / 2

    def reaches(m: int, of: int) -> float:
        like = np.exp(m * np.log(p) + (of - m) * np.log1p(-p) - (m * math.log(max(m, 1) / of) + (of - m) * math.log(max(of - m, 1) / of)))
        return float(like[grid >= jaccard].sum() / like.sum())

    least = [next(m for m in range(of + 1) if reaches(m, of) >= miss) for of in range(64, 64 * batches + 1, 64)]
    of = 64 * batches
    return least, next((m for m in range(of + 1) if reaches(m, of) >= sure), of)


@cache
def parity_limits(miss: float, most: int = 4 * 64 * PARITY) -> np.ndarray:
    """limits[d]: a text pair with at most d words that only one of them has differs in more bits of its parity sketches with a chance of at most
    `miss`. From `most` words on the sketches say nothing, and any number will do."""
    bits = 64 * PARITY
    chance, up = np.zeros(bits + 1), (bits - np.arange(bits + 1)) / bits
    chance[0] = 1
    limits = np.zeros(most + 1, np.int64)
    for d in range(1, most):
        chance = np.r_[0, (chance * up)[:-1]] + np.r_[(chance * (1 - up))[1:], 0]
        limits[d] = np.searchsorted(-np.cumsum(chance[::-1])[::-1], -miss) - 1  # the least z of which P(more than z) <= miss
    limits[most] = bits
    return np.maximum.accumulate(limits)


def _agree(rows: list[np.ndarray], i: np.ndarray, j: np.ndarray, least: list[int], similarity: float, limits: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs (i, j) that outlive every batch and, where the rows have them, their parity sketches; with their equal bits."""
    n = rows[2]
    ok = 2 * np.minimum(n[i], n[j]) >= similarity * (n[i] + n[j]) - 1e-9
    i, j = i[ok], j[ok]
    equal = np.zeros(len(i), np.int64)
    for b, at_least in enumerate(least):
        equal = equal + 64 - np.bitwise_count(rows[3 + b][i] ^ rows[3 + b][j]).astype(np.int64)
        ok = equal >= at_least
        i, j, equal = i[ok], j[ok], equal[ok]
    if limits is not None and len(rows) > 3 + BATCHES:
        odd = rows[3 + BATCHES]
        single = np.floor((1 - similarity) * (n[i].astype(np.int64) + n[j]) + 1e-9).astype(np.int64)
        ok = np.bitwise_count(odd[i] ^ odd[j]).sum(axis=1, dtype=np.int64) <= limits[np.minimum(single, len(limits) - 1)]
        i, j, equal = i[ok], j[ok], equal[ok]
    return i, j, equal


def _joined(found: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3


def _within(rows: list[np.ndarray], least: list[int], similarity: float, limits: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Surviving pairs of rows with equal keys; rows are sorted by key and no key has more than GAPS of them."""
    key, found = rows[0], []
    for gap in range(1, min(GAPS, len(key))):
        i = np.flatnonzero(key[gap:] == key[:-gap])
        if not len(i):
            break
        found.append(_agree(rows, i, i + gap, least, similarity, limits))
    return _joined(found)


def _between(rows: list[np.ndarray], left: np.ndarray, right: np.ndarray, wanted, least: list[int], similarity: float, limits: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Surviving pairs of a row of `left` and one of `right` that wanted(i, j) lets pass, tile by tile among rows of like length: most pairs end by
    their first FIRST batches, in arrays that stay in the processor's cache."""
    found, few, waiting = [], 64 * FIRST - least[FIRST - 1], 0
    ends: list[tuple[np.ndarray, np.ndarray]] = []
    left, right = (x[np.argsort(rows[2][x], kind="stable")] for x in (left, right))
    words_, length = [rows[3 + b][right] for b in range(FIRST)], rows[2][right]

    def settle() -> None:
        i, j = (np.concatenate(x) for x in zip(*ends))
        ok = wanted(i, j)
        found.append(_agree(rows, i[ok], j[ok], least, similarity, limits))
        ends.clear()

    for a in range(0, len(left), TILE):
        own = left[a : a + TILE]
        mine = [rows[3 + b][own][:, None] for b in range(FIRST)]
        share = similarity / (2 - similarity)
        low, high = np.searchsorted(length, share * rows[2][own[0]] - 1e-6), np.searchsorted(length, rows[2][own[-1]] / share + 1e-6, "right")
        for c in range(low, high, STEP):
            to = min(c + STEP, high)
            unequal = np.bitwise_count(mine[0] ^ words_[0][c:to])
            for b in range(1, FIRST):
                unequal += np.bitwise_count(mine[b] ^ words_[b][c:to])
            i, j = np.divmod(np.flatnonzero(unequal <= few), to - c)
            if len(i):
                ends.append((own[i], right[c:to][j]))
                waiting += len(i)
            if waiting > 200_000:
                settle()
                waiting = 0
    if ends:
        settle()
    return _joined(found)


def _ranks(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each place its rank by y among those with the same x."""
    order = np.lexsort((y, x))
    out = np.empty(len(x), np.int64)
    start, size = _groups(x[order])
    out[order] = np.arange(len(x)) - np.repeat(start, size)
    return out


def _fold(stand: list[np.ndarray], follow: np.ndarray, rows: list[np.ndarray], least: list[int], certain: int, similarity: float, limits: np.ndarray | None = None) -> tuple[list[tuple[np.ndarray, np.ndarray]], list[np.ndarray], np.ndarray]:
    """Further rows of one key are compared with those that stand and with each other: (candidate pairs, the rows that stand now, how many rows are
    certainly near each). In a bucket of more than BLOCK rows, a row that is certainly near one which already has FOLLOW such rows is linked to it and let go."""
    pairs, large = [], len(stand[0]) + len(rows[0]) > BLOCK
    for at in range(0, len(rows[0]), STEP):
        block = [np.concatenate([s, r[at : at + STEP]]) for s, r in zip(stand, rows)]
        old, size = len(stand[0]), len(block[0])
        i, j, equal = _between(block, np.arange(size), np.arange(old, size), np.less, least, similarity, limits)
        gone = np.zeros(size, bool)
        follow = np.r_[follow, np.zeros(size - old, np.int64)]
        if large and len(i):
            sure = equal >= certain
            a, b = i[sure], j[sure]
            gone[b[_ranks(a, b) + follow[a] >= FOLLOW]] = True
            follow += np.bincount(a, minlength=size)
            kept = ~gone[j] | (_ranks(j, i) < KEPT)
            i, j = i[kept], j[kept]
        pairs.append((block[1][i], block[1][j]))
        stand, follow = [b[~gone] for b in block], follow[~gone]
    return pairs, stand, follow


def _large(rows: list[np.ndarray], least: list[int], certain: int, similarity: float, limits: np.ndarray | None = None) -> tuple[list[tuple[np.ndarray, np.ndarray]], list[np.ndarray]]:
    """Of the rows of one key: candidate pairs, and the rows that stand for all."""
    return _fold([r[:0] for r in rows], np.zeros(0, np.int64), rows, least, certain, similarity, limits)[:2]


def _pair_batch(pairs: list[tuple[np.ndarray, np.ndarray]], tell: bool = False) -> Iterator[pa.RecordBatch]:
    if pairs and sum(len(a) for a, _ in pairs):
        a, b = (np.concatenate(x) for x in zip(*pairs))
        columns = [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))]
        yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(a), pa.int64())], names=["a", "b", "key"]) if tell else pa.RecordBatch.from_arrays(columns, schema=_PAIR)


def _told(ids: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ids), pa.nulls(len(ids), pa.int64()), pa.array(keys)], names=["a", "b", "key"])


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return start, np.diff(np.r_[start, len(key)])


def _bands(batches: Iterator[pa.RecordBatch], similarity: float, miss: float) -> Iterator[pa.RecordBatch]:
    """A row per text and band. A key with more than BLOCK rows in one batch is thinned before it travels: only the rows that stand for it go on,
    the links of the others travel as rows with n = -1 that hold a pair, and the others as rows with n = -2 that hold id and key, wherever there is room."""
    (least, certain), limits = bounds(similarity / (2 - similarity), miss), parity_limits(miss)
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(3 + BATCHES).flatten().to_numpy()
        order = np.argsort(key, kind="stable")
        text = order // BANDS
        whole = [batch.column(c).to_numpy() for c in range(2 + BATCHES)]
        rows = [key[order], *(w[text].view(_U) if c >= 2 else w[text] for c, w in enumerate(whole)), _unpacked(batch.column(2 + BATCHES))[text]]
        start, size = _groups(rows[0])
        out = [[r[np.repeat(size <= BLOCK, size)]] for r in rows]
        for s, n in zip(start[size > BLOCK], size[size > BLOCK]):
            pairs, stand = _large(these := [r[s : s + n] for r in rows], least, certain, similarity, limits)
            for o, r in zip(out, stand):
                o.append(r)
            gone = these[1][~np.isin(these[1], stand[1])]
            for a, b, what in (*((a, b.view(_U), -1) for a, b in pairs), (gone, np.full(len(gone), these[0][0], np.int64).view(_U), -2)):
                fill = np.zeros(len(a), _U)
                told = [mix(a.view(_U) ^ mix(b)).view(np.int64), a, np.full(len(a), what, np.int32), b, *[fill] * (BATCHES - 1), np.zeros((len(a), PARITY), _U)]
                for o, r in zip(out, told):
                    o.append(r)
        flat = [np.concatenate(o) for o in out]
        yield pa.RecordBatch.from_arrays([*(pa.array(r.view(np.int64) if c != 2 else r) for c, r in enumerate(flat[:-1])), _packed(flat[-1])], schema=_BAND)


def _links(batches: Iterator[pa.RecordBatch], similarity: float, miss: float, tell: bool = False) -> Iterator[pa.RecordBatch]:
    """Candidate pairs of one partition sorted by key; with `tell` also (id, null, key) for every row that was let go. Of the last key it holds the rows
    that stand between batches."""
    (least, certain), limits = bounds(similarity / (2 - similarity), miss), parity_limits(miss)
    held: tuple[list[np.ndarray], np.ndarray] | None = None

    def fold(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        nonlocal held
        before = held or ([r[:0] for r in rows], np.zeros(0, np.int64))
        pairs, *held = _fold(*before, rows, least, certain, similarity, limits)
        yield from _pair_batch(pairs, tell)
        ids = np.r_[before[0][1], rows[1]]
        if tell and len(held[0][0]) < len(ids):
            gone = ids[~np.isin(ids, held[0][1])]
            yield _told(gone, np.full(len(gone), rows[0][0]))

    for batch in batches:
        rows = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(3 + BATCHES)]
        rows = [r.view(_U) if c >= 3 else r for c, r in enumerate(rows)]
        if batch.num_columns > len(rows):
            rows.append(_unpacked(batch.column(3 + BATCHES)))
        for what in (-1, -2):
            made = rows[2] == what
            if made.any():
                one, other = rows[1][made], rows[3][made].view(np.int64)
                if what == -1:
                    yield from _pair_batch([(one, other)], tell)
                elif tell:
                    yield _told(one, other)
                rows = [r[~made] for r in rows]
        if not len(rows[0]):
            continue
        start, size = _groups(rows[0])
        first, last = 0, start[-1]
        if held is not None and held[0][0][0] == rows[0][0]:
            first = size[0]
            yield from fold([r[:first] for r in rows])
            if first == len(rows[0]):
                continue
        held = None
        whole = (start >= first) & (start < last)
        many = np.repeat(whole & (size <= GAPS) & (size > 1), size)
        part = [r[many] for r in rows]
        i, j, _ = _within(part, least, similarity, limits)
        yield from _pair_batch([(part[1][i], part[1][j])], tell)
        for s, n in zip(start[whole & (size > GAPS)], size[whole & (size > GAPS)]):
            yield from fold([r[s : s + n] for r in rows])
            held = None
        yield from fold([r[last:] for r in rows])


def _across(group: pa.Table, similarity: float, miss: float) -> pa.Table:
    """Of one task of a thinned key: the candidate pairs of an own row and another of a different class, one of which was let go."""
    (least, _), limits = bounds(similarity / (2 - similarity), miss), parity_limits(miss)
    group = group.combine_chunks()
    col = lambda c: group.column(c).to_numpy()
    rows = [col("key"), col("id"), col("n"), *(col(f"s{i}").view(_U) for i in range(BATCHES)), _unpacked(group.column("odd").combine_chunks() if group.num_rows else pa.array([], pa.binary()))]
    own, of, rest, gone = col("own"), col("class"), col("rest"), col("gone")
    # two rows outside the largest class meet twice
    wanted = lambda i, j: (of[i] != of[j]) & (gone[i] | gone[j]) & (~rest[j] | (rows[1][i] < rows[1][j]))
    i, j, _ = _between(rows, np.flatnonzero(own), np.flatnonzero(~own), wanted, least, similarity, limits)
    a, b = rows[1][i], rows[1][j]
    return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)}, schema=_PAIR)


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted token hashes of each text, repeats told apart."""
    for batch in batches:
        doc, code, vocabulary = words(batch.column(1))
        token = mix(hashes(vocabulary)[code] + occurrence(doc, code).astype(_U) * _U(0x9E3779B97F4A7C15)).view(np.int64)
        order = np.lexsort((token, doc))
        ends = np.r_[0, np.cumsum(np.bincount(doc, minlength=batch.num_rows))] if len(doc) else np.zeros(batch.num_rows + 1)
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(token[order]))], names=["id", "tokens"])


def _verify(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Exact: the pairs (a, b, tokens of a, tokens of b) that share enough words."""
    for batch in batches:
        if not batch.num_rows:
            continue
        m, total, inside = batch.num_rows, np.zeros(batch.num_rows, np.int64), []
        for c in (2, 3):
            col = batch.column(c)
            length = np.diff(col.offsets.to_numpy())
            inside.append((np.repeat(np.arange(m), length), col.flatten().to_numpy()))
            total += length
        pair, token = np.concatenate([inside[0][0], inside[1][0]]), np.concatenate([inside[0][1], inside[1][1]])
        order = np.lexsort((token, pair))
        pair, token = pair[order], token[order]
        both = np.bincount(pair[1:][(pair[1:] == pair[:-1]) & (token[1:] == token[:-1])], minlength=m)
        yield batch.select([0, 1]).filter(pa.array(2 * both >= similarity * total - 1e-9))


def _rest(alone: DataFrame, gone: DataFrame, classes: DataFrame, similarity: float, miss: float) -> DataFrame:
    """The candidate pairs (a, b) of thinned keys whose rows lie in different classes so far and one of which was let go there; all others were
    compared. Each key's largest class isn't compared with itself; every row outside it is compared in tasks of CHUNK by PART rows."""
    keys = materialize(gone.select("key").distinct())
    each = alone.select("id", "n", *_SKETCH, F.explode(F.concat(*(f"keys{p}" for p in range(PASSES)))).alias("key")).join(small(keys), "key", "left_semi")
    named = each.join(classes.select("id", F.col("component").alias("class")), "id", "left").withColumn("class", F.coalesce("class", "id"))
    named = materialize(named.join(gone.select("key", "id", F.lit(True).alias("gone")), ["key", "id"], "left").withColumn("gone", F.coalesce("gone", F.lit(False))))
    per = named.groupBy("key", "class").agg(F.count("*").alias("c"), F.count_if("gone").alias("g")).groupBy("key").agg(F.max_by(F.struct("class", "g"), "c").alias("top"), F.sum("c").alias("all"), F.max("c").alias("most"), F.sum("g").alias("g"))
    per = materialize(per.where("all > most").select("key", "top.class", F.ceil(F.expr(f"(all - most) / {CHUNK}")).alias("chunks"), F.ceil(F.expr(f"all / {PART}")).alias("parts"), F.expr("g > top.g").alias("every")).withColumnRenamed("class", "top"))
    rows = named.join(small(per), "key").withColumn("rest", F.expr("class <> top"))
    kept = ("key", "id", "n", *_SKETCH, "class", "rest", "gone")
    own = rows.where("rest").select(*kept, F.expr("pmod(xxhash64(id, 1), chunks)").alias("chunk"), F.explode(F.expr("sequence(0L, parts - 1)")).alias("part"), F.lit(True).alias("own"))
    others = rows.where("gone or every").select(*kept, F.explode(F.expr("sequence(0L, chunks - 1)")).alias("chunk"), F.expr("pmod(xxhash64(id, 2), parts)").alias("part"), F.lit(False).alias("own"))
    return own.unionByName(others).groupBy("key", "chunk", "part").applyInArrow(lambda task: _across(task, similarity, miss), "a long, b long").distinct()


def _links_of(pairs: DataFrame, rows: DataFrame, similarity: float) -> DataFrame:
    """Those of the materialised candidate pairs that are near by their words."""
    named = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    tokens = materialize(rows.join(small(materialize(named)), "id", "left_semi").mapInArrow(_tokens, "id long, tokens array<long>"))
    drop_shuffles(rows.sparkSession)
    joined = pairs.join(tokens.select(F.col("id").alias("a"), F.col("tokens").alias("x")), "a").join(tokens.select(F.col("id").alias("b"), F.col("tokens").alias("y")), "b")
    links = materialize(joined.select("a", "b", "x", "y").mapInArrow(partial(_verify, similarity=similarity), "a long, b long"))
    release(pairs, tokens)
    return links


def near_duplicate_links(df: DataFrame, key: str = "chunk_no", text: str = "text", similarity: float = SIMILARITY, miss: float = MISS) -> DataFrame:
    """(a, b): the verified links between rows with near texts; of texts with one bag of words the least id stands for all, each of which is linked to it.

    Words are runs of letters, marks and digits in lower case. Two texts are near if twice their common words, repeats counted, are at least
    `similarity` of the sum of both word counts; a class is whatever such links join. Texts with one bag of words are one from the start,
    however many. Null and blank texts, and those without any word, belong to no class. Keys must be unique; a row with a null key is left out.
    Extra columns are never read; an empty table gives no rows."""
    rows = spread(df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).where(F.col("id").isNotNull() & F.col("text").isNotNull()))
    keys = ", ".join(f"keys{p} array<long>" for p in range(PASSES))
    signed = materialize(rows.mapInArrow(_signatures, f"id long, bag_a long, bag_b long, n int, {_SKETCH_TYPES}, {keys}"))
    first = signed.groupBy("bag_a", "bag_b").agg(F.min("id").alias("class"), F.count("*").alias("copies")).where("copies > 1").drop("copies")
    copies = materialize(signed.select("id", "bag_a", "bag_b").join(first, ["bag_a", "bag_b"]).select("id", "class"))
    more = copies.where("id <> class").select("id")
    alone, hinted = signed.drop("bag_a", "bag_b").join(small(more), "id", "left_anti"), more.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    if not hinted:  # one shuffle of the sketches instead of one a pass
        alone = materialize(alone)
        release(signed)
    wanted = {"similarity": similarity, "miss": miss}
    met = []
    for p in range(PASSES):
        banded = alone.select("id", "n", *_SKETCH, f"keys{p}").mapInArrow(partial(_bands, **wanted), f"key long, id long, n int, {_SKETCH_TYPES}")
        sorted_ = banded.repartition("key").sortWithinPartitions("key")
        met.append(materialize(sorted_.mapInArrow(partial(_links, tell=True, **wanted), "a long, b long, key long").distinct()))
        del banded, sorted_
        drop_shuffles(df.sparkSession)
    every_met = reduce(DataFrame.unionByName, met)
    pairs = materialize(every_met.where("b is not null").select("a", "b").distinct())
    gone = materialize(every_met.where("b is null").select("key", F.col("a").alias("id")).distinct())
    thinned = not gone.isEmpty()
    release(*met, *(() if thinned else (signed, alone)))
    links = _links_of(pairs, rows, similarity)
    joint = links.unionByName(copies.select(F.col("class").alias("a"), F.col("id").alias("b")))
    if thinned:
        again = _links_of(materialize(_rest(alone, gone, components(materialize(joint)), **wanted)), rows, similarity)
        joint = joint.unionByName(again)
    joint = materialize(joint)
    release(signed, alone)
    return joint


def near_duplicate_classes(df: DataFrame, key: str = "chunk_no", text: str = "text", similarity: float = SIMILARITY, miss: float = MISS) -> DataFrame:
    """(id, class): the class of every row whose text is near another's; class is the least id in it. Rows without such a neighbour are left out.
    Terms as in near_duplicate_links."""
    return components(near_duplicate_links(df, key, text, similarity, miss)).select("id", F.col("component").alias("class"))


def near_duplicate_rows(df: DataFrame, key: str = "chunk_no", text: str = "text", similarity: float = SIMILARITY, miss: float = MISS) -> DataFrame:
    """(id, class, links): one row per row of a class, with the number of verified links it has: of rows with one bag of words the least id has those of all."""
    links = near_duplicate_links(df, key, text, similarity, miss)
    count = links.where("a <> b").select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("links"))
    return components(links).select("id", F.col("component").alias("class")).join(count, "id")
