"""Near duplicates by SimHash and the generalised pigeonhole principle.

1. Each text gets a 64-bit fingerprint from the hashes of its shingles of words. Equal fingerprints are one node.
2. On a bounded sample of fingerprints, correlated bits are grouped into partitions. Two fingerprints within ``radius`` bits
   must, for any thresholds that add up to ``radius - partitions + 1``, be within the threshold in at least one partition
   (-1 leaves a partition out). The number of partitions and their unequal thresholds are chosen by dynamic programming on
   candidate counts estimated from the sample. The sample decides what the search costs, never what it finds.
3. Every fingerprint is indexed under its value in each partition and probes all values within that partition's threshold.
   Values with very many fingerprints are parted further: the bits outside the partition are cut into ``radius + 1`` blocks,
   one of which has to be equal. Candidates of one value are verified by their whole distance inside a task, which gives
   the links as a spanning forest: as many rows as fingerprints, not as pairs. No link is lost for the components.
4. Components of the links, by star contraction.

Texts are lower-cased A-Z only. Fewer words than a shingle give one shingle, none give the fingerprint zero, as null texts
do. Null ids stay null and never name a component unless nothing else does; repeated rows have equal fingerprints and so one
component. An empty table gives no rows, other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchloom.llm.components import components, forest
from batchloom.llm.texts import U64, Words, binaries, pieces
from batchloom.sources.files import write_scratch

BITS = 64
SAMPLE = 10_000
#: What comparing two fingerprints inside a task costs, against shuffling one entry of the index.
PAIR_COST = 0.005
#: Fingerprints of one value of a partition above which it is parted further.
CROWDED = 2_000


def fingerprints_of(texts: list[bytes], shingle: int) -> np.ndarray:
    words = Words([t.lower() for t in texts])
    n = np.where(words.counts > 0, np.maximum(1, words.counts - shingle + 1), 0)
    begin = np.repeat(words.first[:-1] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
    end = np.minimum(begin + shingle, np.repeat(words.first[1:], n)) - 1
    data, digest = words.data, xxhash.xxh64_intdigest
    hashes = np.array([digest(data[a:b], 42) for a, b in zip(words.starts[begin].tolist(), words.ends[end].tolist(), strict=True)], dtype=U64)
    # Count bits in blocks of at most 255 shingles of one text, eight counters to a word.
    blocks = -(-n // 255)
    at = np.repeat(np.cumsum(n) - n, blocks) + 255 * (np.arange(int(blocks.sum())) - np.repeat(np.cumsum(blocks) - blocks, blocks))
    out = np.zeros(len(texts), dtype=U64)
    full = np.flatnonzero(n)
    if not len(full):
        return out
    first_block = (np.cumsum(blocks) - blocks)[full]
    for shift in range(8):
        lanes = np.add.reduceat((hashes >> U64(shift)) & U64(0x0101010101010101), at).view(np.uint8).reshape(-1, 8)
        counts = np.add.reduceat(lanes, first_block, axis=0, dtype=np.int64)
        for byte in range(8):
            out[full] |= (2 * counts[:, byte] > n[full]).astype(U64) << U64(8 * byte + shift)
    return out


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """Rows (doc_id, fp); ``fp`` is the fingerprint as a signed integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, limit=1 << 20):
                found = fingerprints_of(binaries(part.column("text")), shingle)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, "doc_id bigint, fp bigint")


def group_bits(sample: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of nearly equal size, correlated bits together."""
    bits = ((sample[:, None] >> np.arange(BITS, dtype=U64)) & U64(1)).astype(float)
    bits -= bits.mean(axis=0)
    norm = np.sqrt((bits**2).sum(axis=0))
    alike = np.abs(bits.T @ bits) / np.maximum(np.outer(norm, norm), 1e-9)
    left = list(range(BITS))
    out = []
    for k in range(parts, 0, -1):
        size = -(-len(left) // k)
        inner = alike[np.ix_(left, left)].sum(axis=0)
        group = [left.pop(int(np.argmax(inner)))]
        while len(group) < size:
            group.append(left.pop(int(np.argmax(alike[np.ix_(group, left)].sum(axis=0)))))
        out.append(sorted(group))
    return out


def allocate(cost: np.ndarray, budget: int) -> tuple[float, list[int]]:
    """Thresholds (from -1 on) that add up to ``budget`` with the least total; ``cost[i, e + 1]`` is that of e in part i."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in cost:
        then: dict[int, tuple[float, list[int]]] = {}
        for spent, (total, chosen) in best.items():
            for e, c in enumerate(row, start=-1):
                found = (total + c, [*chosen, e])
                if spent + e not in then or found[0] < then[spent + e][0]:
                    then[spent + e] = found
        best = then
    return best.get(budget, (float("inf"), []))


def scheme(sample: np.ndarray, total: int, radius: int) -> list[tuple[list[int], int]]:
    """Partitions with their thresholds, those that are left out not included."""
    rng = np.random.default_rng(7)
    pairs = sample[rng.integers(0, len(sample), (200_000, 2))] if len(sample) > 1 else np.zeros((1, 2), dtype=U64)
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    differ = pairs[:, 0] ^ pairs[:, 1]
    choices = []
    for parts in range(1 if radius < 2 else 2, radius + 4):  # one partition would probe every fingerprint in reach
        groups = group_bits(sample, parts)
        cost = np.zeros((parts, radius + 2))
        for i, group in enumerate(groups):
            mask = U64(sum(1 << b for b in group))
            distance = np.bitwise_count(differ & mask)
            near = 1.0  # values within the threshold
            for e in range(radius + 1):
                if e:
                    near *= (len(group) - e + 1) / e + 1
                share = max(float((distance <= e).mean()) if len(differ) else 0.0, near / 2.0 ** len(group))
                cost[i, e + 1] = total * near + PAIR_COST * share * total * total / 2
        choices.append((*allocate(cost, radius - parts + 1), groups))
    _, thresholds, groups = min(choices, key=lambda c: c[0])
    return [(g, e) for g, e in zip(groups, thresholds, strict=True) if e >= 0]


def _gather(fp: Column, bits: list[int]) -> Column:
    """The chosen bits of a fingerprint, packed."""
    value = F.lit(0).cast("bigint")
    for place, bit in enumerate(bits):
        value = value.bitwiseOR(F.shiftleft(F.shiftrightunsigned(fp, bit).bitwiseAND(F.lit(1).cast("bigint")), place))
    return value


def _masks(width: int, radius: int) -> list[int]:
    return [sum(1 << b for b in chosen) for e in range(radius + 1) for chosen in combinations(range(width), e)]


def _probed(part: int, value: Column, masks: list[int]) -> Column:
    """Entries of a partition for the value under every mask."""
    signed = [m - (m >> 63 << 64) for m in masks]
    return F.transform(
        F.array(*[F.lit(m).cast("bigint") for m in signed]),
        lambda m: F.struct(F.lit(part).alias("part"), value.bitwiseXOR(m).alias("value")),
    )


def _entries(nodes: DataFrame, parts: list[tuple[list[int], int]], probe: bool) -> DataFrame:
    """Rows (fp, part, value, probe): where each fingerprint is indexed, or the values other than its own that it probes."""
    found = nodes.select("fp", *[_gather(F.col("fp"), bits).alias(f"value{i}") for i, (bits, _) in enumerate(parts)])
    lists = []
    for i, (bits, e) in enumerate(parts):
        masks = [m for m in _masks(len(bits), e) if m] if probe else [0]
        if masks:
            lists.append(_probed(i, F.col(f"value{i}"), masks))
    if not lists:
        return nodes.limit(0).select("fp", F.lit(0).alias("part"), F.col("fp").alias("value"), F.lit(probe).alias("probe"))
    return found.select("fp", F.explode(F.concat(*lists)).alias("e")).select("fp", "e.part", "e.value", F.lit(probe).alias("probe"))


def link_group(index: np.ndarray, probes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a forest that joins fingerprints of one value within ``radius``: index with index, probes with index."""
    index = np.unique(index)
    own = np.unique(np.concatenate((index, probes)))
    if len(own) * len(index) <= 2081 * 64 * len(own):  # few enough to compare each with all
        a, b = [], []
        step = max(1, (1 << 22) // max(1, len(index)))
        for low in range(0, len(own), step):
            near = np.argwhere(np.bitwise_count(own[low : low + step, None] ^ index[None, :]) <= radius)
            x, y = own[low + near[:, 0]], index[near[:, 1]]
            x, y = forest(x[x != y], y[x != y]) if len(near) else (x, y)
            a.append(x)
            b.append(y)
    else:  # look up every fingerprint within the radius
        a, b = [], []
        for mask in _masks(BITS, radius)[1:]:
            wanted = own ^ U64(mask)
            at = np.minimum(np.searchsorted(index, wanted), len(index) - 1)
            hit = index[at] == wanted
            x, y = forest(np.concatenate((own[hit], *a)), np.concatenate((wanted[hit], *b)))
            a, b = [x], [y]
    x, y = np.concatenate(a), np.concatenate(b)
    return forest(x, y) if len(x) else (x, y)


def links(nodes: DataFrame, parts: list[tuple[list[int], int]], radius: int, crowded: int = CROWDED) -> DataFrame:
    """Edges (a, b) between different fingerprints that have the components of all pairs within ``radius``."""
    index, probes = _entries(nodes, parts, False), _entries(nodes, parts, True)
    sizes = index.groupBy("part", "value").agg(F.count("*").alias("n"))
    rows = index.unionByName(probes).join(sizes, ["part", "value"])  # values nobody has need no probe
    if all(e == 0 for _, e in parts):
        rows = rows.where("n > 1")
    finer = []
    for i, (bits, _) in enumerate(parts):
        rest = [b for b in range(BITS) if b not in bits]
        blocks = [rest[k :: radius + 1] for k in range(radius + 1)]
        keys = F.array(*[F.struct(F.lit(k).alias("block"), _gather(F.col("fp"), b).alias("inner")) for k, b in enumerate(blocks)])
        finer.append(F.when(F.col("part") == i, keys))
    whole = F.array(F.struct(F.lit(-1).alias("block"), F.lit(0).cast("bigint").alias("inner")))
    split = rows.withColumn("e", F.explode(F.when(F.col("n") > crowded, F.coalesce(*finer)).otherwise(whole)))
    keyed = split.select(F.xxhash64("part", "value", "e.block", "e.inner").alias("key"), "fp", "probe")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Groups come sorted by key; two keys with one hash only give more candidates to verify."""
        held: list[tuple[np.ndarray, ...]] = []

        def done(key, fp, probe) -> pa.RecordBatch | None:
            begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            size = np.diff(np.append(begin, len(key)))
            a, b = [], []
            for s, n in zip(begin[size > 1].tolist(), size[size > 1].tolist(), strict=True):
                own, probing = fp[s : s + n], probe[s : s + n]
                if not probing.all():
                    x, y = link_group(own[~probing], own[probing], radius)
                    a.append(x)
                    b.append(y)
            if not a:
                return None
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).view(np.int64)) for c in (a, b)], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            own = (np.asarray(batch.column("key")), np.asarray(batch.column("fp")).view(U64), np.asarray(batch.column("probe").to_numpy(zero_copy_only=False)))
            held.append(own)
            if own[0][0] == own[0][-1] and len(held) > 1 and held[-2][0][-1] == own[0][0]:
                continue  # still inside one group
            key, fp, probe = (np.concatenate(c) for c in zip(*held, strict=True))
            keep = int(np.searchsorted(key, key[-1]))
            held = [(key[keep:], fp[keep:], probe[keep:])]
            if keep and (out := done(key[:keep], fp[:keep], probe[:keep])):
                yield out
        if held and (out := done(*(np.concatenate(c) for c in zip(*held, strict=True)))):
            yield out

    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(verify, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2, crowded: int = CROWDED) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id of its component)."""
    own = write_scratch(fingerprints(docs, shingle), "fingerprints")
    nodes = write_scratch(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    sample = nodes.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).toPandas()["fp"].to_numpy(dtype=np.int64)
    if not len(sample):
        return own.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("doc_id").alias("component_id"))
    parts = scheme(sample.view(U64), nodes.count(), radius)
    roots = components(links(nodes.select("fp"), parts, radius, crowded))
    labelled = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    names = labelled.join(named, "root").select("fp", "component_id")
    return own.join(names, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
