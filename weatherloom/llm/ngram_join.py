"""Documents linked by the Jaccard similarity of their word shingles, through parity sketches.

A document's set is its distinct five-word shingles (lower-cased A-Z, words
between ASCII white space); a text with fewer words is one shingle, a text
without words has the empty set and links with nothing.

* **Sketch.** For its size band (sizes up to a power of two) a set has a sketch of
  eight times as many words as the band's largest set has shingles. Each shingle
  XORs its 64-bit hash into the one word that its upper bits name, so the number
  of words in which two sketches differ is at most the symmetric difference of
  the sets. A set that may have partners in the band below has a second sketch
  there. In bands of sizes up to ``2**EXACT`` every shingle has a word of its own.
* **Pigeonhole.** Sets above the similarity share most of their words. The
  ``WORDS`` filled words smallest in hash order are the keys of the set. A pair at
  the threshold shares about seven tenths of them; that they share no more than a
  quarter has a probability below 1e-10, of the order of equal hashes of unlike
  shingles. (In bands up to ``2**EXACT`` all shingles are keys, and the bound is exact:
  of a union of u, 3u/4 or more are shared and at most u/2 go as hot. In the band above
  shingles may meet in one of 512 words.) So of each set's keys the most frequent quarter may go when they are
  hot, which takes passages shared by very many texts out of the join.
* **Verify.** A second parity sketch of 512 bits bounds the symmetric difference
  from below and drops most candidates; the rest are compared exactly, by whole
  sets.

Equal sets are collapsed before the join. In a bucket no list of all pairs is
made: members are compared with three of them (the lowest id, the one that shares most
keys with others, which is the text that near copies were made from, and one by
hash), links found so merge them into components, and only pairs of a bucket that lie
in different components go on, filtered by size and sketch within the join.

Rows with one id are one node, linked if any of their texts are. Rows without an
id are returned with a null component and link with nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weatherloom.llm.common import components, joined, lists, map_rows, mix, shingle_sets, signed
from weatherloom.session import cut_lineage

WORDS = 48
EXACT = 5
HOT = 32
SPARSITY_BITS = 3
BITS = 512
LANES = [f"b{i}" for i in range(BITS // 64)]

FEATURES = "doc_id long, n long, sum long, xor long, home array<long>, below array<long>, " + ", ".join(f"{b} long" for b in LANES)


def sketch_keys(hashes: np.ndarray, level: int) -> np.ndarray:
    """The smallest keys of a set's sketch for the band of sizes up to 2**level. ``hashes`` is sorted."""
    if level <= EXACT:  # no two shingles in one word, and no more of them than WORDS
        return np.sort(mix(hashes + np.uint64(level << 56)))
    cells = hashes >> np.uint64(64 - level - SPARSITY_BITS)
    firsts = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1])))
    words = np.bitwise_xor.reduceat(hashes, firsts)
    keys = joined(mix(cells[firsts] + np.uint64(level << 56)), words)
    keys = keys[words != 0]
    return np.sort(np.partition(keys, WORDS)[:WORDS] if len(keys) > WORDS else keys)


def levels(n: int) -> list[int]:
    """The band of n, and the one below if a set there can be similar."""
    home = max(0, (n - 1).bit_length())
    return [home, home - 1] if home and 3 * n <= 4 << (home - 1) else [home]


def common_count(first: np.ndarray, second: np.ndarray) -> int:
    """The number of values that two sorted sets share."""
    if len(second) == 0:
        return 0
    at = np.minimum(np.searchsorted(second, first), len(second) - 1)
    return int((second[at] == first).sum())


def parity_bits(hashes: np.ndarray) -> np.ndarray:
    odd = np.bincount((hashes & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _features(rows: dict[str, list]) -> dict:
    sets = shingle_sets(rows["text"])
    out: dict = {"doc_id": rows["doc_id"], "n": [len(s) for s in sets], "home": [], "below": []}
    sums, xors, bits = [], [], []
    for hashes in sets:
        spread = mix(hashes + np.uint64(1))
        sums.append(spread.sum(dtype=np.uint64))
        xors.append(np.bitwise_xor.reduce(spread * hashes) if len(hashes) else np.uint64(0))
        bits.append(parity_bits(hashes))
        bands = levels(len(hashes)) if len(hashes) else []
        for name, level in zip(("home", "below"), [*bands, None, None][:2], strict=True):
            out[name].append(np.empty(0, np.int64) if level is None else signed(sketch_keys(hashes, level)))
    out["sum"], out["xor"] = signed(np.array(sums, np.uint64)), signed(np.array(xors, np.uint64))
    out |= {name: lists(out[name], pa.int64()) for name in ("home", "below")}
    return out | dict(zip(LANES, np.array(bits).reshape(-1, len(LANES)).T.copy(), strict=True))


def _similar_sizes(a: str, b: str, percent: int) -> Column:
    return F.expr(f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})")


def _close_bits(a: str, b: str, percent: int) -> Column:
    """Differing bits are no more than the symmetric difference may be."""
    differing = " + ".join(f"bit_count({a}.{lane} ^ {b}.{lane})" for lane in LANES)
    return F.expr(f"({100 + percent}) * ({differing}) <= ({100 - percent}) * ({a}.n + {b}.n)")


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the similarity."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))

    def linked(rows: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {"a": [], "b": []}
        place = {text: i for i, text in enumerate(dict.fromkeys([*rows["text_a"], *rows["text_b"]]))}
        sets = shingle_sets(list(place))
        for a, b, x, y in zip(rows["a"], rows["b"], rows["text_a"], rows["text_b"], strict=True):
            first, second = sets[place[x]], sets[place[y]]
            common = common_count(first, second)
            if common and 100 * common >= percent * (len(first) + len(second) - common):
                out["a"].append(a)
                out["b"].append(b)
        return out

    return map_rows(pairs.join(left, "a").join(right, "b"), "a long, b long", linked, ["a", "b", "text_a", "text_b"], 64)


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, n_links_found.

    Two documents link when 100 * |intersection| >= percent * |union|. The
    component is the smallest doc_id reachable by links. ``n_links_found`` is not the
    number of a document's links: it counts those found between the set's representative and others on the way; equal
    sets are not counted, and links inside a component already known are not
    searched.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = cut_lineage(map_rows(docs, FEATURES, _features, ["doc_id", "text"]))
    filled = made.filter("n > 0 and doc_id is not null")
    same = ["n", "sum", "xor"]
    reps = filled.groupBy(*same).agg(F.min("doc_id").alias("rep"))
    # the lowest id of each set stands for it; an id with several texts stands for each
    members = cut_lineage(filled.select("doc_id", *same).join(reps, same).select("doc_id", *same, "rep"))
    chosen = filled.join(members.filter("doc_id = rep").select("doc_id", *same).distinct(), ["doc_id", *same], "left_semi")

    listed = chosen.select(F.col("doc_id").alias("rep"), F.posexplode(F.array("home", "below")).alias("band", "keys"))
    keyed = listed.select("rep", "band", F.size("keys").alias("size"), F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("times")).filter("times > 1")
    found = keyed.join(shared, "key")
    by_heat = Window.partitionBy("rep", "band").orderBy(F.desc("times"), "key")
    found = found.withColumn("rank", F.row_number().over(by_heat)).withColumn("heat", F.sum("times").over(Window.partitionBy("rep", "band")))
    buckets = cut_lineage(found.filter(f"times <= {HOT} or rank > floor(size / 4)").groupBy("key", "rep").agg(F.max("heat").alias("heat")))

    sizes = chosen.select(F.col("doc_id").alias("rep"), F.struct("n", *LANES).alias("s"))
    texts = docs.filter("doc_id is not null and text is not null")

    pivots = buckets.groupBy("key").agg(
        F.min("rep").alias("p0"),
        F.max_by("rep", F.struct("heat", "rep")).alias("p1"),
        F.min_by("rep", F.xxhash64("rep")).alias("p2"),
    )
    stars = (
        buckets.join(pivots, "key")
        .select("rep", F.explode(F.array_distinct(F.array("p0", "p1", "p2"))).alias("pivot"))
        .filter("rep <> pivot")
        .select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b"))
        .distinct()
    )
    stars = cut_lineage(_close(stars, sizes, percent))
    links = cut_lineage(_verified(stars, texts, percent).distinct())
    shared_ids = members.groupBy("doc_id").agg(F.count_distinct("rep").alias("reps")).filter("reps > 1")
    of_one_id = members.join(shared_ids, "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))

    known = components(links.unionByName(of_one_id))
    placed = buckets.join(known.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    split = placed.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), (F.count("*") > HOT).alias("large")
    )
    open_rows = placed.join(split.filter("low < high").select("key", "large"), "key").join(sizes, "rep")
    # members of large buckets share many keys; their pairs are made at the first of them alone
    own = Window.partitionBy("rep")
    keys = F.when(F.max("large").over(own), F.collect_set("key").over(own))
    open_rows = open_rows.select("key", "rep", "component", "s", keys.alias("keys"))
    x, y = open_rows.alias("x"), open_rows.alias("y")
    across = (
        x.join(
            y,
            (F.col("x.key") == F.col("y.key"))
            & (F.col("x.rep") < F.col("y.rep"))
            & (F.col("x.component") != F.col("y.component"))
            & _similar_sizes("x.s.n", "y.s.n", percent)
            & _close_bits("x.s", "y.s", percent)
            & F.expr("x.keys is null or y.keys is null or array_min(array_intersect(x.keys, y.keys)) = x.key"),
        )
        .select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))
        .distinct()
        .join(stars, ["a", "b"], "left_anti")
    )
    across = cut_lineage(across)
    more = _verified(across, texts, percent).distinct()
    links = cut_lineage(links.unionByName(more).distinct())
    final = components(links.unionByName(of_one_id))

    degree = (
        links.select(F.col("a").alias("rep"))
        .unionByName(links.select(F.col("b").alias("rep")))
        .groupBy("rep")
        .agg(F.count("*").alias("n_links_found"))
    )
    per_set = reps.join(final.withColumnRenamed("node", "rep"), "rep", "left").join(degree, "rep", "left")
    return made.select("doc_id", *same).join(per_set, same, "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id")).alias("component_id"),
        F.coalesce("n_links_found", F.lit(0)).cast("long").alias("n_links_found"),
    )


def _close(pairs: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sizes and 512-bit sketches allow the similarity."""
    both = pairs.join(sizes.withColumnRenamed("s", "x").withColumnRenamed("rep", "a"), "a")
    both = both.join(sizes.withColumnRenamed("s", "y").withColumnRenamed("rep", "b"), "b")
    return both.filter(_similar_sizes("x.n", "y.n", percent) & _close_bits("x", "y", percent)).select("a", "b").distinct()


def one_of_each(docs: DataFrame, percent: int = 75) -> DataFrame:
    """The documents without their near duplicates: of each component the one with the smallest id stays.

    Rows that repeat the kept id with another text are near duplicates of one
    another only if they link; all rows of the kept id stay. Rows without an id stay.
    """
    found = near_duplicates(docs, percent)
    goes = found.filter("component_id <> doc_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(goes, docs["doc_id"] == goes["_gone"], "left_anti")
