"""Problem 5: groups of records whose sets of word runs overlap by more than a threshold.

T-occurrence search over inverted lists. A partner of a record with n distinct runs shares at least T of them. Runs
are ordered from rare to frequent; the T - COUNT most frequent ones are the record's long lists, the others its short
lists, so a partner stands on at least COUNT short lists. Short lists are merged shard by shard, pairs whose
signatures differ in more places than linked sets can are dropped there, occurrences of the others are counted for
each pair over all shards, and for pairs that occur often enough the long lists are probed by binary search until the
whole overlap is known.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlake.operators.graph import connected_components
from auditlake.runtime import cut_lineage, in_slices

RUN = 3
#: Linked if overlap / union is above NUMERATOR / DENOMINATOR.
NUMERATOR, DENOMINATOR = 3, 5
#: Occurrences on short lists that make a pair a candidate. Each costs one more short list a record, and leaves far fewer pairs.
COUNT = 4
#: Counters of the frequency sketch; it fixes the order of runs and which lists are split, never the result.
SKETCH_BITS = 20
SLICES = 16
#: Postings for one shard; a task merges one shard at a time, and each shard has the signatures of its sets.
SHARD_POSTINGS = 3_000_000
#: Bits of a set's signature, each the parity of the runs that fall on it: two sets have at least as many different runs as bits.
SIGN_BITS = 512
#: A list longer than LONG_LIST is merged in cells, whose sizes differ by less than this factor.
LONG_LIST, CELL = 32, 1.05
#: Postings of one list from which it is split into blocks, each pair of which is merged by itself.
LIST_POSTINGS = 1 << 18
#: Pairs looked at in one vector operation.
CHUNK = 1 << 19
#: Chosen records up to this many (some 100 bytes each) go to every task; more meet the texts by shuffle.
BROADCAST_ROWS = 100_000
#: Texts of one slice; their numbers fit 16 bits.
BATCH = 1_000
HASH_BITS = 48
_WORDS = re.compile(r"[a-z0-9_]+").findall
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def least_overlap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest overlap with which sets of these sizes are linked."""
    return NUMERATOR * (a + b) // (NUMERATOR + DENOMINATOR) + 1


def short_lists(n: np.ndarray, count: int = COUNT) -> np.ndarray:
    """How many of n runs count as short lists: all but T - count, T being the least overlap with any partner."""
    return np.minimum(n, n - NUMERATOR * n // DENOMINATOR - 1 + count)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _A
    x = (x ^ (x >> np.uint64(32))) * _B
    return x ^ (x >> np.uint64(31))


class Runs:
    """Distinct word runs of many texts at once, as 48-bit hashes."""

    def __init__(self, run: int = RUN):
        self.run, self.codes = run, _Codes()

    def sets(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, text numbers) of all runs, each once a text, by text and hash; 65 536 texts at most."""
        words = [_WORDS(t.lower()) for t in texts]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        codes = np.fromiter((c for w in words for c in map(self.codes.__getitem__, w)), np.uint64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(texts), dtype=np.uint64), sizes)
        n = len(codes) - self.run + 1
        if n <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        whole = owner[:n] == owner[self.run - 1 :]
        key = np.zeros(n, np.uint64)
        for k in range(self.run):
            key = key * _C + codes[k : k + n]
        both = np.sort(owner[:n][whole] << np.uint64(HASH_BITS) | mixed(key[whole]) >> np.uint64(64 - HASH_BITS))
        both = both[np.r_[True, both[1:] != both[:-1]]] if len(both) else both
        return both & np.uint64((1 << HASH_BITS) - 1), (both >> np.uint64(HASH_BITS)).astype(np.int64)


class _Codes(dict):
    """64-bit codes of words, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        raw = word.encode()
        code = self[word] = zlib.crc32(raw) << 32 | zlib.crc32(raw[::-1] + b"#" + raw)
        return code


def class_ids(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One id for each set (sorted hashes from each start on): equal sets have equal ids."""
    if not len(starts):
        return np.empty(0, np.uint64)
    return mixed(np.add.reduceat(mixed(hashes ^ _C), starts) ^ np.bitwise_xor.reduceat(hashes * _B, starts))


def first_of_each(owner: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.empty(0, np.int64)


def text_of(*columns: str) -> Column:
    return F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in columns])


def read_sets(texts: DataFrame, kind: str, run: int, bits: int) -> DataFrame:
    """(k, class_id) of every text with a run, and (s, c): counts of runs by bucket in SLICES slices, packed.

    One pass gives both; a partition counts all its texts before it yields its slices.
    """
    width = (1 << bits) // SLICES
    columns = ["k", "class_id", "s", "c"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, runs = np.zeros(1 << bits, np.int64), Runs(run)
        for part in in_slices(batches, BATCH):
            hashes, owner = runs.sets(list(part["t"]))
            if not len(hashes):
                continue
            total += np.bincount((hashes & np.uint64((1 << bits) - 1)).astype(np.int64), minlength=1 << bits)
            starts = first_of_each(owner)
            rows = pd.DataFrame({"k": part["k"].to_numpy()[owner[starts]], "class_id": class_ids(hashes, starts).view(np.int64)})
            yield rows.assign(s=pd.Series([None] * len(rows), dtype="Int32"), c=None)[columns]
        if total.any():
            packed = [zlib.compress(total[k * width : (k + 1) * width].astype("<u4").tobytes(), 1) for k in range(SLICES)]
            yield pd.DataFrame({"k": None, "class_id": pd.Series([None] * SLICES, dtype="Int64"), "s": pd.Series(range(SLICES), dtype="Int32"), "c": packed})[columns]

    return texts.mapInPandas(read, f"k {kind}, class_id long, s int, c binary")


def frequency_sketch(counts: DataFrame, bits: int) -> tuple[np.ndarray, int]:
    """(log2 counts in eighths by bucket, all runs). Slices are summed one partial at a time; 2^bits totals reach the driver."""
    width = (1 << bits) // SLICES

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for part in batches:
            for s, c in zip(part["s"], part["c"]):
                sums[s] = sums.get(s, 0) + np.frombuffer(zlib.decompress(c), "<u4").astype(np.int64)
        yield pd.DataFrame({"s": list(sums), "c": [x.astype("<i8").tobytes() for x in sums.values()]})

    total = np.zeros(1 << bits, np.int64)
    for s, c in counts.select("s", "c").repartition(SLICES, "s").mapInPandas(add, "s int, c binary").collect():
        total[s * width : (s + 1) * width] = np.frombuffer(c, "<i8")
    return np.minimum(255, 8 * np.log2(np.maximum(total, 1))).astype(np.uint8), int(total.sum())


def in_blocks(lists: np.ndarray, ids: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the posting, list, side) with every posting of a list in n blocks once for each block its own one meets.

    A list of one block keeps its name and has side 2; where block i meets block j, i < j, their postings are on sides
    0 and 1 of a list named after all three, and only unlike sides are paired.
    """
    at = np.repeat(np.arange(len(lists)), blocks)
    other = np.arange(len(at)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    n = blocks[at]
    own = (mixed(ids[at] ^ _A) % n.astype(np.uint64)).astype(np.int64)
    low, high = np.minimum(own, other), np.maximum(own, other)
    name = np.where(n == 1, lists[at], mixed(lists[at] ^ mixed((low << 32 | high).astype(np.uint64) + _C)))
    return at, name, np.where(low == high, 2, own > other)


def signatures(hashes: np.ndarray, place: np.ndarray, sets: int) -> np.ndarray:
    """One row of 64-bit words for each set."""
    bits = (mixed(hashes + _A) % np.uint64(SIGN_BITS)).astype(np.int64)
    odd = np.bincount(place * SIGN_BITS + bits, minlength=sets * SIGN_BITS) & 1
    return np.packbits(odd.astype(np.uint8).reshape(sets, SIGN_BITS), axis=1).view("<u8")


def postings(texts: DataFrame, order: object, run: int, shards: int, list_postings: int) -> DataFrame:
    """(shard, sets, runs): per slice and shard, the sets with short lists there and their postings, packed.

    Equal sets of a slice are combined before the shuffle. A set is its class id, size and signature (76 bytes, with
    the posting's side, in each shard that has a list of it), a posting a list (32 bits, which can only add
    candidates), the set's place in the blob and the run's rank in it (8 bytes).
    """

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        runs, ranks = Runs(run), order.value
        mask = np.uint64(len(ranks) - 1)
        for part in in_slices(batches, BATCH):
            hashes, owner = runs.sets(list(part["t"]))
            if not len(hashes):
                continue
            starts = first_of_each(owner)
            sizes = np.diff(np.r_[starts, len(hashes)])
            _, first = np.unique(ids := class_ids(hashes, starts), return_index=True)
            keep = np.zeros(len(starts), bool)
            keep[first] = True
            hashes = hashes[np.repeat(keep, sizes)]
            ids, sizes = ids[keep], sizes[keep]
            place = np.repeat(np.arange(len(ids)), sizes)
            signs = signatures(hashes, place, len(ids))
            often = ranks[(hashes & mask).astype(np.int64)]
            by_rank = np.argsort((place << 8 | often).astype(np.uint32), kind="stable")  # equally frequent ones stay by hash
            rank = np.arange(len(hashes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            by_rank = by_rank[short := rank < np.repeat(short_lists(sizes), sizes)]
            lists, place, rank, often = hashes[by_rank], place[short], rank[short], often[by_rank]
            blocks = np.ceil(np.exp2(often / 8) / list_postings).astype(np.int64)
            side = np.full(len(lists), 2)
            if (blocks > 1).any():
                at, lists, side = in_blocks(lists, ids[place], blocks)
                place, rank = place[at], rank[at]
            shard = (mixed(lists + _B) % np.uint64(shards)).astype(np.int64)
            by_shard = np.argsort(shard, kind="stable")
            lists, place, rank, side, shard = lists[by_shard], place[by_shard], rank[by_shard], side[by_shard], shard[by_shard]
            cuts = [*first_of_each(shard), len(shard)]
            out = []
            for a, b in zip(cuts, cuts[1:]):
                used, local = np.unique(place[a:b] << 2 | side[a:b], return_inverse=True)
                head = ids[used >> 2].astype("<u8"), (sizes[used >> 2] << 2 | used & 3).astype("<u4"), signs[used >> 2]
                body = lists[a:b].astype("<u4"), local.astype("<u2"), np.minimum(rank[a:b], 65_535).astype("<u2")
                out.append((int(shard[a]), *(b"".join(x.tobytes() for x in xs) for xs in (head, body))))
            yield pd.DataFrame(out, columns=["shard", "sets", "runs"])

    return texts.select("t").mapInPandas(pack, "shard int, sets binary, runs binary")


def meetings(lists: np.ndarray, n: np.ndarray, reach: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Postings (a, b) of one list with n[a] <= n[b] and n[a] <= reach[b], each pair once, and few with n[b] > reach[a].

    Cells of like size within a list are ordered by falling reach, so that a posting's partners in a cell are one
    stretch of it; a list that isn't long is one cell.
    """
    long, most = np.bincount(lists)[lists] > LONG_LIST, int(n.max())
    cell, top = (np.where(long, np.log(x) // np.log(CELL), 0).astype(np.int64) for x in (n, np.clip(reach, n, most)))
    cells, span = lists * (int(top.max()) + 1) + cell, most + 1
    order = np.lexsort((-reach, cells))
    keys = cells[order] * span + most - np.clip(reach[order], 0, most)
    smaller = order[(reach >= n)[order]]
    for step in range(int((top - cell).max()) + 1):
        smaller = smaller[cell[smaller] + step <= top[smaller]]
        first = (cells[smaller] + step) * span
        low, high = np.searchsorted(keys, first), np.searchsorted(keys, first + most - n[smaller], side="right")
        ends, at = np.cumsum(high - low), 0
        while at < len(smaller):
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK, side="right")))
            c = high[at:upto] - low[at:upto]
            a = np.repeat(smaller[at:upto], c)
            b = order[np.arange(len(a)) + np.repeat(low[at:upto] - np.cumsum(c) + c, c)]
            at = upto
            if not step:
                once = (n[a] < n[b]) | ((n[a] == n[b]) & (a < b))
                a, b = a[once], b[once]
            yield a, b


def merged(sets: list[bytes], runs: list[bytes], count: int = COUNT) -> tuple[np.ndarray, ...]:
    """(a, b, occurrences, least) of the pairs of class ids that meet on one shard's short lists, a < b.

    Within a list only postings are paired whose sizes and ranks let the least overlap still be reached; of these
    pairs, those stay whose signatures don't show that it isn't. least is how often a pair has to occur over all shards.
    """
    words = SIGN_BITS // 64
    numbers = [len(x) // (12 + 8 * words) for x in sets]
    heads = [(np.frombuffer(x, "<u8", k), np.frombuffer(x, "<u4", k, 8 * k), np.frombuffer(x, "<u8", k * words, 12 * k).reshape(k, words)) for x, k in zip(sets, numbers)]
    offset = np.cumsum([0, *numbers])
    parts = [(np.frombuffer(x, "<u4", len(x) // 8), np.frombuffer(x, "<u2", len(x) // 8, len(x) // 2).astype(np.int64) + offset[k], np.frombuffer(x, "<u2", len(x) // 8, len(x) // 8 * 6)) for k, x in enumerate(runs)]
    run, place, rank = (np.concatenate([p[i] for p in parts]) for i in range(3))
    ids, one, same = np.unique(np.concatenate([h[0] for h in heads]), return_index=True, return_inverse=True)
    signs = np.concatenate([h[2] for h in heads])[one]
    size = np.concatenate([h[1] for h in heads]).astype(np.int64)
    n, side, place, rank = size[place] >> 2, size[place] & 3, same[place], rank.astype(np.int64)
    order = np.lexsort((place, run))
    order = order[np.r_[True, (run[order][1:] != run[order][:-1]) | (place[order][1:] != place[order][:-1])]]  # copies from several slices stand once
    lists = np.cumsum(np.r_[0, run[order][1:] != run[order][:-1]])
    met = np.bincount(lists)[lists] > 1
    order, lists = order[met], lists[met]
    place, rank, n, side = place[order], rank[order], n[order], side[order]
    # of the first ``count`` shared runs, at most count - 1 lie before this one
    most = n - rank + np.minimum(rank, count - 1)
    reach = (most * (NUMERATOR + DENOMINATOR) - 1) // NUMERATOR - n
    found = []
    for a, b in meetings(lists, n, reach) if len(lists) else ():
        need = least_overlap(n[a], n[b])
        before = np.minimum(np.minimum(rank[a], rank[b]), count - 1)
        ok = (np.minimum(n[a] - rank[a], n[b] - rank[b]) + before >= need) & ((side[a] == 2) | (side[a] != side[b]))
        a, b, need = a[ok], b[ok], need[ok]
        x, y = place[a], place[b]
        ok = np.bitwise_count(signs[x] ^ signs[y]).sum(1, dtype=np.int64) <= n[a] + n[b] - 2 * need
        x, y, need = x[ok], y[ok], np.minimum(need[ok], count)
        found.append(np.stack([np.minimum(x, y) * len(ids) + np.maximum(x, y), need]))
    pairs, first, times = np.unique(np.concatenate([f[0] for f in found] or [np.empty(0, np.int64)]), return_index=True, return_counts=True)
    least = np.concatenate([f[1] for f in found] or [np.empty(0, np.int64)])[first]
    return ids[pairs // len(ids)].view(np.int64), ids[pairs % len(ids)].view(np.int64), times, least


def packed_pairs(a: np.ndarray, b: np.ndarray, times: np.ndarray, least: np.ndarray, parts: int) -> list[tuple[int, bytes]]:
    """(part, blob) of pairs by the part of their first class: it stands once, its partners (9 bytes each) follow."""
    part = (mixed(a.view(np.uint64)) % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((a, part))
    a, b, part = a[order], b[order], part[order]
    code = (np.minimum(times, 63) << 2 | least - 1)[order]  # a pair that occurs COUNT times is a candidate, so 63 are enough
    out, cuts = [], [*first_of_each(part), len(part)]
    for x, y in zip(cuts, cuts[1:]):
        first = first_of_each(a[x:y])
        pieces = (np.array([len(first)], "<u4"), a[x:y][first].astype("<i8"), np.diff(np.r_[first, y - x]).astype("<u4"), b[x:y].astype("<i8"), code[x:y].astype(np.uint8))
        out.append((int(part[x]), b"".join(p.tobytes() for p in pieces)))
    return out


def counted_pairs(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of all blobs of a part that occur often enough in total."""
    parts = []
    for x in blobs:
        n = int(np.frombuffer(x, "<u4", 1)[0])
        times, at = np.frombuffer(x, "<u4", n, 4 + 8 * n), 4 + 12 * n
        m = (len(x) - at) // 9
        parts.append((np.repeat(np.frombuffer(x, "<i8", n, 4), times), np.frombuffer(x, "<i8", m, at), np.frombuffer(x, np.uint8, m, at + 8 * m)))
    a, b, code = (np.concatenate([p[i] for p in parts]) for i in range(3))
    ids, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    pairs, first, same = np.unique(place[: len(a)] * len(ids) + place[len(a) :], return_index=True, return_inverse=True)
    often = np.bincount(same, code >> 2) > (code[first] & 3)
    return ids[pairs[often] // len(ids)], ids[pairs[often] % len(ids)]


def packed(hashes: np.ndarray) -> bytes:
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : HASH_BITS // 8].tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) * 8 // HASH_BITS, 8), np.uint8)
    out[:, : HASH_BITS // 8] = np.frombuffer(raw, np.uint8).reshape(-1, HASH_BITS // 8)
    return out.view("<u8").ravel()


def linked(a: bytes, b: bytes) -> bool:
    """Whether two sorted sets overlap by more than the threshold: the smaller one's runs are probed in the larger."""
    x, y = sorted((unpacked(a), unpacked(b)), key=len)
    if not len(x):
        return False
    at = np.searchsorted(y, x)
    shared = int((y[np.minimum(at, len(y) - 1)] == x).sum())
    return shared >= NUMERATOR * (len(x) + len(y)) // (NUMERATOR + DENOMINATOR) + 1


def candidate_pairs(texts: DataFrame, sketch: tuple[np.ndarray, int], run: int = RUN, shard_postings: int = SHARD_POSTINGS, list_postings: int = LIST_POSTINGS) -> DataFrame:
    """(a, b), a < b: classes that occur together on enough short lists, no linked pair missing.

    Repeated occurrences are counted in their shard, and a pair's counts meet in the part of its first class.
    """
    spark = texts.sparkSession
    order, total = spark.sparkContext.broadcast(sketch[0]), sketch[1]
    cores = spark.sparkContext.defaultParallelism
    shards = max(2 * cores, total * (DENOMINATOR - NUMERATOR) // DENOMINATOR // shard_postings)
    parts = max(cores, shards, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: dict[int, tuple[list, list]] = {}
        for part in batches:
            for s, a, b in zip(part["shard"], part["sets"], part["runs"]):
                lists = waiting.setdefault(s, ([], []))
                lists[0].append(a)
                lists[1].append(b)
        for s in list(waiting):
            a, b, times, least = merged(*waiting.pop(s))
            for k in range(0, len(a), CHUNK):
                yield pd.DataFrame(packed_pairs(a[k : k + CHUNK], b[k : k + CHUNK], times[k : k + CHUNK], least[k : k + CHUNK], parts), columns=["part", "pairs"])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: dict[int, list[bytes]] = {}
        for part in batches:
            for p, x in zip(part["part"], part["pairs"]):
                waiting.setdefault(p, []).append(x)
        for p in list(waiting):
            a, b = counted_pairs(waiting.pop(p))
            yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    met = postings(texts, order, run, shards, list_postings).repartitionById(shards, "shard").mapInPandas(merge, "part int, pairs binary")
    return met.repartitionById(parts, "part").mapInPandas(count, "a long, b long")


def overlap_links(df: DataFrame, key: str, text: Column, run: int = RUN, **sizes: int) -> tuple[DataFrame, DataFrame]:
    """(members, links) of the records with a text.

    members: key, class_id; records with equal sets of runs share a class. links: a, b, pairs of class ids whose sets
    overlap by more than the threshold, none missing. Null texts and texts of fewer words than a run are in no class.
    A key that repeats belongs to the classes of all its texts. Two passes over the texts (classes and frequencies,
    short lists) and one over those that a candidate needs; nothing that grows with the texts reaches the driver.
    """
    texts = df.select(F.col(key).alias("k"), text.alias("t")).where("t is not null and k is not null")
    kind = df.schema[key].dataType.simpleString()
    seen = cut_lineage(read_sets(texts, kind, run, SKETCH_BITS))
    members = seen.where("s is null").select("k", "class_id")
    pairs = cut_lineage(candidate_pairs(texts, frequency_sketch(seen.where("s is not null"), SKETCH_BITS), run, **sizes))

    # of each class that a candidate names, one record's text gives the set
    wanted = pairs.select(F.col("a").alias("class_id")).union(pairs.select("b")).distinct()
    chosen = cut_lineage(members.join(wanted, "class_id", "left_semi").groupBy("class_id").agg(F.min("k").alias("k")))
    if chosen.count() <= BROADCAST_ROWS:
        chosen = F.broadcast(chosen)

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        runs = Runs(run)
        for part in in_slices(batches, BATCH):
            hashes, owner = runs.sets(list(part["t"]))
            starts = first_of_each(owner)
            ids, bounds = class_ids(hashes, starts).view(np.int64), [*starts, len(hashes)]
            rows = pd.DataFrame({"class_id": ids, "runs": [packed(hashes[a:b]) for a, b in zip(bounds, bounds[1:])]})
            yield rows[ids == part["class_id"].to_numpy()[owner[starts]]]  # a repeated key has other texts too

    one = texts.join(chosen, "k").select("t", "class_id").mapInPandas(sets, "class_id long, runs binary").repartition("class_id")

    @F.pandas_udf("boolean")
    def overlaps(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([linked(x, y) for x, y in zip(a, b)], dtype=bool)

    left = one.select(F.col("class_id").alias("a"), F.col("runs").alias("ra"))
    right = one.select(F.col("class_id").alias("b"), F.col("runs").alias("rb"))
    links = pairs.join(left, "a").join(right, "b").where(overlaps("ra", "rb")).select("a", "b").distinct()
    return members.withColumnRenamed("k", key), links


def overlap_groups(df: DataFrame, key: str, text: Column, run: int = RUN, **sizes: int) -> DataFrame:
    """(key, class_id, group_id) of every record with a text of at least one run.

    Groups are everything linked directly or through others; copies share a class, so however many there are, they
    add no pairs. A key whose texts lie in several classes joins them.
    """
    members, links = overlap_links(df, key, text, run, **sizes)
    links = cut_lineage(links)
    members = members.distinct()
    several = members.groupBy(key).agg(F.min("class_id").alias("a"), F.max("class_id").alias("b")).where("a <> b")
    joins = several.select(key, "a").join(members, key).select("a", F.col("class_id").alias("b")).where("a <> b")
    groups = connected_components(links.union(joins))
    return members.join(groups.withColumnsRenamed({"node": "class_id", "component": "group_id"}), "class_id", "left").select(
        key, "class_id", F.coalesce("group_id", "class_id").alias("group_id")
    )


def group_pairs(groups: DataFrame, key: str) -> DataFrame:
    """(key_a, key_b), a < b: all pairs of keys of one group. The size is that of the result; groups say the same in short."""
    one = groups.select(key, "group_id").distinct()
    many = one.groupBy("group_id").agg(F.count("*").alias("n")).where("n > 1").select("group_id")
    one = one.join(many, "group_id", "left_semi")
    a = one.select("group_id", F.col(key).alias(f"{key}_a"))
    b = one.select("group_id", F.col(key).alias(f"{key}_b"))
    return a.join(b, "group_id").where(f"{key}_a < {key}_b").select(f"{key}_a", f"{key}_b").distinct()
