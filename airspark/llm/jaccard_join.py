"""Exact Jaccard self-join of documents' word n-gram sets by universe partitioning.

Sets are grouped by size bands.  Two sets of one group that reach the similarity differ in at most H
elements, so when the universe of n-grams is hashed into H + 1 segments they agree on one segment
(pigeonhole).  Every set is indexed under each segment's subset.  An empty segment would agree with a large
part of all sets; it is skipped, and paid for by looking at one of K reserved segments with one deletion
allowed: under those, each set is indexed under all subsets lacking one element too.  K is chosen for each
group by expected cost.  A set with more empty segments than K can pay for looks the rest up exactly.

Equal sets are one set.  Candidates are screened by profiles: element counts of coarse segments, whose
L1 distance no pair's difference can be under.  Buckets are screened in blocks of bounded size, and a block
hands on no more links than join its members.  Sets that screened links connect form a cluster, and the
sets of a cluster are compared whole, exactly, again in blocks; so nothing lists the pairs of a group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint, mix64, per_text, text_or_empty
from .components import components

BLOCK = 256
PROFILE = 64  # segments of a small set's profile
SEEN_SETS = 100_000
CHUNK_WORDS = 400_000
SUBSET, LESS_ONE, EMPTY, EMPTY_PROBE = 0, 1, 2, 3
_U = np.uint64


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of a text's words, A-Z lower-cased, cut at ASCII white space."""
    import xxhash
    h = xxhash.xxh3_64_intdigest
    return np.array([h(w) for w in text.encode("utf-8", "surrogatepass").lower().split()], dtype=_U)


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles; fewer words make one shingle, none the empty set."""
    if not len(words):
        return words
    if len(words) < n:
        n = len(words)
    at = len(words) - n + 1
    x = np.full(at, n, dtype=_U)
    for i in range(n):
        x = mix64(x + words[i: i + at])
    return np.unique(x)


def set_digest(x: np.ndarray) -> int:
    """A signed 64-bit digest of a set; equal sets have equal digests."""
    total = mix64(mix64(x + _U(0x51ED2701)).sum(dtype=_U)[None] + _U(len(x)))
    return int(total.view(np.int64)[0])


def profile(x: np.ndarray) -> bytes:
    """Elements of the set in each of its coarse segments, counted up to 255.

    PROFILE segments, or for a large set a power of two that is a quarter of its size or more: with less,
    chance makes large unrelated sets look near.
    """
    bits = max(PROFILE, len(x) // 4 - 1).bit_length() if len(x) > 4 * PROFILE else PROFILE.bit_length() - 1
    segment = (mix64(x ^ _U(0x7F4A7C15)) >> _U(64 - bits)).astype(np.int64)
    return np.minimum(np.bincount(segment, minlength=1 << bits), 255).astype(np.uint8).tobytes()


def folded(profiles: list[bytes]) -> np.ndarray:
    """The profiles as rows, all folded to the shortest's segments (neighbours' counts add up)."""
    rows = [np.frombuffer(p, dtype=np.uint8) for p in profiles]
    width = min(map(len, rows))
    return np.stack([r.reshape(width, -1).sum(axis=1, dtype=np.int32) for r in rows])


def may_reach(distance, a, b, percent: int):
    """Whether sets of sizes a and b whose profiles are ``distance`` apart can reach the similarity."""
    return reaches((a + b - distance) // 2, a, b, percent)


@lru_cache(None)
def band_starts(percent: int, most: int = 1 << 40) -> tuple[int, ...]:
    """First sizes of the bands: a set's partners that are not smaller lie in its band or the next one."""
    starts = [1, 2]
    while starts[-1] < most:
        starts.append(max(starts[-1] + 1, (starts[-1] - 1) * 100 // percent + 1))
    return tuple(starts)


def max_difference(group: int, percent: int) -> int:
    """H: elements in which a pair of the group (bands ``group`` and the next one) can differ."""
    a = band_starts(percent)[group + 1] - 1
    return (a + a * 100 // percent) * (100 - percent) // (100 + percent)


def spare_segments(group: int, percent: int, n_sets: int) -> int:
    """K by cost: index rows for the reserved segments against candidates from empty segments not paid for."""
    m, s = max_difference(group, percent) + 1, band_starts(percent)[group]
    p = (1 - 1 / m) ** s
    best, best_cost = 0, math.inf
    mean = m * p
    term, tail, excess = math.exp(-mean), 1 - math.exp(-mean), mean  # Poisson: P(Z = k), P(Z > k), E (Z - k)+
    for k in range(m + 1):
        cost = n_sets * k * (s / m) + n_sets * n_sets * p * max(excess, 0.0)
        if cost < best_cost:
            best, best_cost = k, cost
        excess -= max(tail, 0.0)
        term *= mean / (k + 1)
        tail -= term
    return best


def signatures(sets: list[np.ndarray], digests: np.ndarray, percent: int, spares: dict[int, int],
               lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature, digest, kind) rows of the sets for their own band's group, or for the one below."""
    starts = np.array(band_starts(percent))
    sizes = np.array([len(x) for x in sets])
    group = np.searchsorted(starts, sizes, side="right") - 1 - int(lower)
    spare = np.array([spares.get(int(g), -1) for g in group])
    use = np.flatnonzero(spare >= 0)  # groups with H = 0 hold equal sets only
    if not len(use):
        return np.empty(0, _U), np.empty(0, np.int64), np.empty(0, np.int8)
    x = np.concatenate([sets[i] for i in use])
    sizes, group, spare, digests = sizes[use], group[use], spare[use], digests[use]
    differ = {int(g): max_difference(int(g), percent) for g in np.unique(group)}
    m = np.array([differ[int(g)] + 1 for g in group])
    base = np.concatenate([[0], np.cumsum(m)])
    owner = np.repeat(np.arange(len(use)), sizes)
    salt = mix64(group.astype(_U) + _U(0xA5A5))
    segment = ((mix64(x ^ salt[owner]) >> _U(32)) * m.astype(_U)[owner] >> _U(32)).astype(np.int64)
    at = base[owner] + segment
    y = mix64(x + _U(0x2545F491))
    count = np.bincount(at, minlength=base[-1])
    low = np.bincount(at, weights=(y & _U(0xFFFFFFFF)).astype(np.float64), minlength=base[-1])
    high = np.bincount(at, weights=(y >> _U(32)).astype(np.float64), minlength=base[-1])
    total = (high.astype(_U) << _U(32)) + low.astype(_U)  # sums of the elements' hashes modulo 2^64
    of = np.repeat(np.arange(len(use)), m)
    number = np.arange(base[-1]) - base[of]
    name = mix64(salt[of] + number.astype(_U))
    # Subsets of non-empty segments.
    full = np.flatnonzero(count)
    parts = [(mix64(total[full] ^ name[full]), of[full], SUBSET)]
    # Subsets lacking one element, of reserved segments with two or more.
    one = np.flatnonzero((segment < spare[owner]) & (count[at] > 1))
    parts.append((mix64((total[at[one]] - y[one]) ^ name[at[one]]), owner[one], LESS_ONE))
    # Empty segments: all are looked up by those sets that cannot pay for skipping theirs.
    none = np.flatnonzero(count == 0)
    if len(none):
        z = np.bincount(of[none], minlength=len(use))
        pay = np.bincount(of[(number < spare[of]) & (count > 1)], minlength=len(use))
        rank = np.arange(len(none)) - np.searchsorted(of[none], of[none])
        probe = rank < (z - pay)[of[none]]
        mark = mix64(name[none] ^ _U(0x0E0E))
        parts += [(mark[~probe], of[none][~probe], EMPTY), (mark[probe], of[none][probe], EMPTY_PROBE)]
    return (np.concatenate([s for s, _, _ in parts]), digests[np.concatenate([o for _, o, _ in parts])],
            np.concatenate([np.full(len(s), k, np.int8) for s, _, k in parts]))


def _signature_rows(words: int, percent: int, spares: dict[int, int]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()  # copies met again in a task need not be signed again

        def out(sets, digests):
            for lower in (False, True):
                s, d, k = signatures(sets, np.array(digests, dtype=np.int64), percent, spares, lower)
                yield pd.DataFrame({"sig": s.view(np.int64), "rec": d, "kind": k})

        for b in batches:
            sets, digests, size = [], [], 0
            for text in b["text"]:
                x = shingle_set(word_hashes(text), words)
                d = set_digest(x)
                if not len(x) or d in seen:
                    continue
                if len(seen) >= SEEN_SETS:
                    seen.clear()
                seen.add(d)
                sets.append(x)
                digests.append(d)
                size += len(x)
                if size >= CHUNK_WORDS:
                    yield from out(sets, digests)
                    sets, digests, size = [], [], 0
            if sets:
                yield from out(sets, digests)
    return run


def reaches(common, a, b, percent: int):
    return 100 * common >= percent * (a + b - common)


def _screen_pairs(percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            far = []
            for pair in zip(b["u_profile"], b["v_profile"]):
                u, v = folded(pair)
                far.append(int(np.abs(u - v).sum()))
            near = may_reach(np.array(far, dtype=np.int64), b["u_size"].to_numpy(), b["v_size"].to_numpy(), percent)
            yield b.loc[near, ["u", "v"]]
    return run


def forest(n: int, pairs) -> list[tuple[int, int]]:
    """Of the index pairs those that join something new: at most n - 1."""
    parent, tree = list(range(n)), []

    def top(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in pairs:
        a, z = top(i), top(j)
        if a != z:
            parent[z] = a
            tree.append((i, j))
            if len(tree) == n - 1:
                break
    return tree


def near_profiles(profiles: np.ndarray, sizes: np.ndarray, percent: int, cross_from: int = 0):
    """Index pairs (i < j) that may reach the similarity; j >= cross_from > i if it is set."""
    n = len(sizes)
    for i in range(cross_from or n - 1):
        low = cross_from or i + 1
        far = np.abs(profiles[low:] - profiles[i]).sum(axis=1, dtype=np.int64)
        for j in np.flatnonzero(may_reach(far, sizes[i], sizes[low:], percent)):
            yield i, low + int(j)


def block_links(sets: list[np.ndarray], percent: int, cross_from: int = 0) -> list[tuple[int, int]]:
    """Index pairs (i < j) that reach the similarity; j >= cross_from > i if it is set.

    Exact: counts common elements by products of 0/1 matrices, a slice of the shared vocabulary at a time.
    """
    n = len(sets)
    sizes = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(n), sizes)
    _, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(count > 1)
    column = np.full(len(count), -1)
    column[shared] = np.arange(len(shared))
    column = column[place]
    common = np.zeros((n, n), dtype=np.float32)
    order = np.argsort(column, kind="stable")
    order = order[np.searchsorted(column[order], 0):]
    step = 4096
    edges = np.searchsorted(column[order], np.arange(0, len(shared) + step, step))
    for k, (s, e) in enumerate(zip(edges, edges[1:])):
        if s < e:
            grid = np.zeros((n, step), dtype=np.float32)
            grid[owner[order[s:e]], column[order[s:e]] - k * step] = 1
            common += grid @ grid.T
    ok = reaches(np.rint(common).astype(np.int64), sizes[:, None], sizes[None, :], percent)
    ok = np.triu(ok, 1)
    if cross_from:
        ok[cross_from:] = False
        ok[:, :cross_from] = False
    return list(zip(*(x.tolist() for x in np.nonzero(ok))))


def _by_block(links_of):
    """Rows sorted by (key, i, j, block): one block, or pair of blocks, of a key's members after the other.

    ``links_of(rows, cross_from)`` gives index pairs; of them a forest goes on.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, rows = None, []

        def out():
            first = sum(r.block == rows[0].block for r in rows) if rows else 0
            cross = key is not None and key[1] != key[2]
            if len(rows) > 1 and not (cross and first == len(rows)):
                tree = forest(len(rows), links_of(rows, first if cross else 0))
                if tree:
                    yield pd.DataFrame({"u": [rows[i].rec for i, _ in tree], "v": [rows[j].rec for _, j in tree]})

        for b in batches:
            for r in b.itertuples(index=False):
                if (r.key, r.i, r.j) != key:
                    yield from out()
                    key, rows = (r.key, r.i, r.j), []
                rows.append(r)
        yield from out()
    return run


def _screen_blocks(percent: int):
    return _by_block(lambda rows, cross: near_profiles(
        folded([r.profile for r in rows]), np.array([r.size for r in rows]), percent, cross))


def _compare_blocks(percent: int):
    return _by_block(lambda rows, cross: block_links(
        [np.frombuffer(r.x, dtype=_U) for r in rows], percent, cross))


def in_blocks(rows: DataFrame, values: DataFrame) -> DataFrame:
    """Rows (key, rec, n: members of the key) with ``values`` joined by rec, in every pair of the key's blocks."""
    placed = (rows.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
              .withColumn("block", F.pmod(F.xxhash64("rec", F.lit("block")), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "rec"))
    return (placed.join(values, "rec").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "block"))


def _describe(words: int):
    def one(text: str) -> tuple:
        x = shingle_set(word_hashes(text), words)
        return len(x), set_digest(x), profile(x)
    return lambda: one


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")).withColumns(
        {"id": F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "digest": F.xxhash64("text")})


def sets_of(docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, id, digest, n_shingles, rec (the set's digest) and profile of every row; written once."""
    return checkpoint(keyed(docs, id_col, text_col)
                      .select("doc_id", "id", "digest",
                              per_text("n_shingles long, rec long, profile binary", _describe(words))("text").alias("s"))
                      .select("doc_id", "id", "digest", "s.*"), "shingle-sets")


def links(docs: DataFrame, described: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """u, v: links between different sets that connect all that the similarity connects."""
    starts = list(band_starts(percent))
    # Distinct sets of each group, for the cost of its spare segments: a few dozen rows.
    sizes = (described.where("n_shingles > 0").groupBy("rec").agg(F.first("n_shingles").alias("n"))
             .groupBy("n").count().collect())
    in_band: dict[int, int] = {}
    for r in sizes:
        band = int(np.searchsorted(starts, r["n"], side="right")) - 1
        in_band[band] = in_band.get(band, 0) + r["count"]
    spares = {g: spare_segments(g, percent, in_band.get(g, 0) + in_band.get(g + 1, 0))
              for b in in_band for g in (b - 1, b) if g >= 0 and max_difference(g, percent) > 0}
    texts = keyed(docs, id_col, text_col)
    rows = texts.select("text").mapInPandas(_signature_rows(words, percent, spares), "sig long, rec long, kind byte")
    bucket = Window.partitionBy("sig")
    wanted = F.max(F.col("kind").isin(SUBSET, EMPTY_PROBE)).over(bucket)  # someone must be looking
    members = (rows.select("*", F.min("rec").over(bucket).alias("hub"), F.max("rec").over(bucket).alias("last"),
                           wanted.alias("wanted"))
               .where((F.col("hub") < F.col("last")) & F.col("wanted")).select("sig", "rec", "kind").distinct())
    members = checkpoint(members, "buckets")
    profiles = checkpoint(
        described.join(members.select("rec").distinct(), "rec").groupBy("rec")
        .agg(F.first("n_shingles").alias("size"), F.first("profile").alias("profile")), "profiles")
    # Buckets of two, and lookups of empty segments, as pairs; larger buckets in blocks.
    probes = members.where(F.col("kind") == EMPTY_PROBE).select("sig", F.col("rec").alias("u"))
    subsets = members.where(F.col("kind") < EMPTY).select("sig", "rec").distinct()
    buckets = subsets.groupBy("sig").agg(F.count("*").alias("n"), F.min("rec").alias("u"), F.max("rec").alias("v"))
    pairs = (buckets.where("n = 2").select("u", "v")
             .union(members.where(F.col("kind") >= EMPTY).join(probes, "sig").where("rec <> u")
                    .select(F.least("u", "rec"), F.greatest("u", "rec"))).distinct())
    for side in ("u", "v"):
        pairs = pairs.join(profiles.select(F.col("rec").alias(side), F.col("size").alias(f"{side}_size"),
                                           F.col("profile").alias(f"{side}_profile")), side)
    large = subsets.join(buckets.where("n > 2").select("sig", "n"), "sig").withColumnRenamed("sig", "key")
    screened = checkpoint(pairs.mapInPandas(_screen_pairs(percent), "u long, v long")
                          .union(in_blocks(large, profiles).mapInPandas(_screen_blocks(percent), "u long, v long"))
                          .distinct(), "screened")
    cluster = components(screened).select(F.col("node").alias("rec"), F.col("component").alias("key"))
    cluster = checkpoint(cluster.join(cluster.groupBy("key").agg(F.count("*").alias("n")), "key"), "clusters")
    # The whole sets of the clusters' members, each from one row that has it.
    reps = (described.join(cluster.select("rec"), "rec").groupBy("rec")
            .agg(F.min(F.struct("id", "digest")).alias("r")).select("rec", "r.*"))

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"rec": b["rec"], "x": [shingle_set(word_hashes(t), words).tobytes() for t in b["text"]]})

    sets = checkpoint(texts.select("id", "digest", "text").join(reps.hint("shuffle_hash"), ["id", "digest"])
                      .select("rec", "text").mapInPandas(whole, "rec long, x binary").dropDuplicates(["rec"]), "sets")
    return checkpoint(in_blocks(cluster, sets).mapInPandas(_compare_blocks(percent), "u long, v long"), "links")


def group_documents(docs: DataFrame, words: int = 4, percent: int = 85, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and the keys id, digest, group of every row of ``docs``.

    Rows link when 100 * |common| >= percent * |union| of their shingle sets; component_id is the smallest
    doc_id that links reach.  NULL and empty texts have the empty set and link with nothing; a text of
    fewer words than a shingle has its whole sequence as one.  Repeated rows have equal sets and link.
    Ids that are NULL take part and get their group's smallest other id.  Sets are named by 64-bit
    digests of 64-bit shingle hashes; similarity is decided on the whole sets.
    """
    described = sets_of(docs, words, id_col, text_col)
    found = components(links(docs, described, words, percent, id_col, text_col))
    grouped = (described.join(found.select(F.col("node").alias("rec"), "component"), "rec", "left")
               .withColumn("group", F.coalesce("component", "rec")))
    smallest = grouped.where("n_shingles > 0").groupBy("group").agg(F.min("doc_id").alias("smallest"))
    return (grouped.join(smallest, "group", "left")
            .withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("smallest")).otherwise(F.col("doc_id")))
            .select("doc_id", "n_shingles", "component_id", "id", "digest", "group"))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all their columns, without all but one document of each group.

    The one with the smallest id stays (rows without id come last; between equal ids the smaller text
    digest); of rows that repeat both id and text one stays.  Documents without words all stay.
    """
    rows = checkpoint(group_documents(docs, words, percent, id_col, text_col).where("n_shingles > 0")
                      .withColumn("place", F.struct(F.col("doc_id").isNull(), "doc_id", "digest")), "groups")
    first = rows.groupBy("group").agg(F.min("place").alias("first"))
    drop = rows.join(first, "group").where(F.col("place") != F.col("first")).select(
        F.col("id").alias("__id"), F.col("digest").alias("__digest")).distinct()
    text = text_or_empty(F.col(f"`{text_col}`"))
    marked = docs.select("*", F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("__id"),
                         F.xxhash64(text).alias("__digest"))
    kept = marked.join(drop, ["__id", "__digest"], "left_anti")
    twice = rows.groupBy("id", "digest").count().where("count > 1").select(
        F.col("id").alias("__id"), F.col("digest").alias("__digest"))
    if twice.take(1):
        kept = kept.join(twice, ["__id", "__digest"], "left_anti").unionByName(
            kept.join(twice, ["__id", "__digest"], "left_semi").dropDuplicates(["__id", "__digest"]))
    return kept.drop("__id", "__digest")
