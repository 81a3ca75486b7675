"""Near-duplicate documents: MinHash bands propose links, full shingle sets confirm them.

Texts with equal shingle sets are one node from the start. In each bucket of a band all nodes
are first held against one pivot, the node that shares most buckets with others. Only buckets
that then still span several components are searched further, in blocks of bounded size inside
tasks; what a block emits are links that join components, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyframe.llm.common import as_bytes, materialise, schema_of
from skyframe.llm.components import connected_components
from skyframe.llm.words import mix, shingles, word_hashes

#: A pair with 0.8 of its shingles in common shares no bucket with probability (1 - 0.8^5)^40 = 1.3e-7.
BANDS, ROWS = 40, 5
HASHES = BANDS * ROWS
#: Probability at most that a pair with just the share in common has no bucket in common.
MISSED = 1.4e-7
#: Nodes of a bucket that meet in one block of the second search.
BLOCK = 256
SHARE = 80

_random = np.random.default_rng(3)
MULTIPLIERS = _random.integers(0, 1 << 63, HASHES, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _random.integers(0, 1 << 63, HASHES, dtype=np.int64).astype(np.uint64)


def rows_for(share: int) -> int:
    """Minima of a band, ``ROWS`` or as many fewer as pairs of that share need to meet in one of the bands."""
    for rows in range(ROWS, 0, -1):
        if (1 - (share / 100) ** rows) ** (HASHES // rows) <= MISSED:
            return rows
    raise ValueError(f"{HASHES} minima do not find pairs that share {share} percent; the smallest share is 8")


def least_agreement(share: int) -> int:
    """Six standard errors below the agreement expected at the share, 0.8 at most."""
    s = min(share, SHARE) / 100
    return int(s * HASHES - 6 * (HASHES * s * (1 - s)) ** 0.5)


def signature(hashes: np.ndarray) -> np.ndarray:
    """Minima of ``HASHES`` universal hash functions (multiply, add, upper 32 bits)."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 1024):
        part = hashes[at : at + 1024]
        table = MULTIPLIERS[:, None] * part[None, :]
        table += OFFSETS[:, None]
        np.minimum(least, table.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def band_keys(minima: np.ndarray, rows: int = ROWS) -> np.ndarray:
    bands = HASHES // rows
    keys = np.arange(bands, dtype=np.uint64)
    for column in minima[: bands * rows].reshape(bands, rows).T:
        keys = mix(keys * np.uint64(0xD1342543DE82EF95) + column.astype(np.uint64))
    return keys.view(np.int64)


def sketches(docs: DataFrame, shingle: int, id_col: str, text_col: str, band: int = ROWS) -> DataFrame:
    """``id, text_hash, n_shingles, set_1, set_2, bands, minima`` per row; the last four null without words.

    ``set_1, set_2`` name the shingle set in 128 bits; ``minima`` holds the lower 16 bits of each minimum.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            sizes, one, two, bands, minima = [], [], [], [], []
            for words in word_hashes(as_bytes(batch.column(2))):
                own = shingles(words, shingle)
                sizes.append(len(own))
                if not len(own):
                    one.append(None), two.append(None), bands.append(None), minima.append(None)
                    continue
                name = np.frombuffer(xxhash.xxh3_128_digest(own.tobytes()), np.int64)
                least = signature(own)
                one.append(int(name[0]))
                two.append(int(name[1]))
                bands.append(band_keys(least, band))
                minima.append(least.astype(np.uint16).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(sizes, pa.int64()),
                    pa.array(one, pa.int64()),
                    pa.array(two, pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(minima, pa.binary()),
                ],
                ["id", "text_hash", "n_shingles", "set_1", "set_2", "bands", "minima"],
            )

    long = T.LongType()
    more = [("text_hash", long), ("n_shingles", long), ("set_1", long), ("set_2", long), ("bands", T.ArrayType(long)), ("minima", T.BinaryType())]
    return rows.mapInArrow(sketch, schema_of(rows.select("id"), *more))


def _agreeing(pairs: DataFrame, nodes: DataFrame, share: int) -> DataFrame:
    """``u, v, agree`` of the pairs whose signatures agree often enough."""

    def side(name: str) -> DataFrame:
        return nodes.select(F.col("node").alias(name), F.col("minima").alias(f"minima_{name}"))

    rows = pairs.select("u", "v").join(side("u"), "u").join(side("v"), "v")
    enough = least_agreement(share)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, HASHES) for i in (2, 3))
            agree = (u == v).sum(axis=1)
            good = pa.array(np.flatnonzero(agree >= enough))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(good), batch.column(1).take(good), pa.array(agree).take(good)], ["u", "v", "agree"]
            )

    return rows.select("u", "v", "minima_u", "minima_v").mapInArrow(compare, schema_of(rows.select("u", "v"), ("agree", T.LongType())))


def _confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, share: int) -> DataFrame:
    """The pairs ``u, v`` whose full shingle sets share enough."""

    def side(name: str) -> DataFrame:
        return texts.select(F.col("node").alias(name), F.col("text").alias(f"text_{name}"))

    rows = pairs.select("u", "v").distinct().join(side("u"), "u").join(side("v"), "v").select("u", "v", "text_u", "text_v")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(word_hashes(as_bytes(batch.column(2))), word_hashes(as_bytes(batch.column(3))), strict=True)
            good = []
            for i, (u, v) in enumerate(both):
                a, b = shingles(u, shingle), shingles(v, shingle)
                if _shares_enough(a, b, share):
                    good.append(i)
            good = pa.array(good, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(good), batch.column(1).take(good)], ["u", "v"])

    return rows.mapInArrow(confirm, rows.select("u", "v").schema)


def _shares_enough(a: np.ndarray, b: np.ndarray, share: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= share * (len(a) + len(b) - common)


def _block_links(shared: DataFrame, nodes: DataFrame, labels: DataFrame, texts: DataFrame, shingle: int, share: int) -> DataFrame:
    """Links ``u, v`` between nodes in one bucket and two components, one at least for any two components linked there.

    Of two nodes in different components, one is outside the largest component of the bucket: a
    probe. Probes look for partners among all members whose sizes the share allows (within a
    quarter of theirs at 80). Both are dealt into blocks, so no task holds a whole bucket; a pair is tried in the
    first bucket that its ends share. Pairs whose signatures agree are confirmed on their full
    sets on the spot, the most alike first, until a probe has a link to each component.
    """
    labelled = shared.select("key", "node").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    parts = labelled.groupBy("key", "component").agg(F.count("*").alias("n"))
    open_keys = (
        parts.groupBy("key")
        .agg(F.count("*").alias("components"), F.sum("n").alias("n"), F.max_by("component", F.struct("n", "component")).alias("largest"))
        .where("components > 1 AND n > 2")
        .select("key", "largest")
    )
    enough = least_agreement(share)
    # Sizes of a linked pair differ by one step at most.
    step = 100 / min(share, SHARE)
    level = F.floor(F.log(F.col("n_shingles").cast("double")) / F.log(F.lit(step))).cast("int")
    members = materialise(
        labelled.join(open_keys, "key")
        .join(nodes.select("node", "n_shingles", "minima", "bands"), "node")
        .join(texts.select("node", "text"), "node")
        .select("key", level.alias("level"), "node", "component", "minima", "bands", "text", (F.col("component") != F.col("largest")).alias("probe")),
        "open-buckets",
    )
    places = members.where("probe").withColumn("level", F.explode(F.array(F.col("level") - 1, F.col("level"), F.col("level") + 1)))

    def chunks(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("key", "level").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name))

    sizes = chunks(members, "members").join(chunks(places, "probes"), ["key", "level"])

    def dealt(rows: DataFrame, own: str, other: str, asks: bool) -> DataFrame:
        """Each row in one block of its own side, against every block of the other."""
        return rows.join(sizes, ["key", "level"]).select(
            "key", "level",
            F.pmod(F.xxhash64("node"), F.col(own)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other),
            F.struct("node", "component", "minima", "bands", "probe", F.lit(asks).alias("asks"), "text").alias("row"),
        )

    both = dealt(members, "members", "probes", False).unionByName(dealt(places, "probes", "members", True))
    groups = both.groupBy("key", "level", "members", "probes").agg(F.collect_list("row").alias("rows"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, column = batch.column(0).to_pylist(), batch.column(1)
            for i, key in enumerate(keys):
                node, component, minima, bands, probe, asks, text = column[i].values.flatten()
                names, probe, asks = node.to_pylist(), probe.to_numpy(zero_copy_only=False), asks.to_numpy(zero_copy_only=False)
                code = component.dictionary_encode().indices.to_numpy()
                least = np.frombuffer(b"".join(minima.to_pylist()), np.uint16).reshape(-1, HASHES)
                buckets = np.array(bands.to_pylist(), np.int64)
                sets: dict[int, np.ndarray] = {}

                def set_of(k: int) -> np.ndarray:
                    if k not in sets:
                        sets[k] = shingles(next(word_hashes(as_bytes(text.slice(k, 1)))), shingle)
                    return sets[k]

                answers, found = np.flatnonzero(~asks), []
                for j in np.flatnonzero(asks):
                    near = answers[code[answers] != code[j]]
                    agree = (least[near] == least[j]).sum(axis=1)
                    near = near[np.argsort(-agree, kind="stable")][: int((agree >= enough).sum())]
                    # Each pair has a bucket in common: this one.
                    near = near[buckets[j][(buckets[near] == buckets[j]).argmax(axis=1)] == key]
                    linked: set[int] = set()
                    for k in near.tolist():
                        if code[k] in linked or (probe[k] and names[j] > names[k]):
                            continue
                        if _shares_enough(set_of(j), set_of(k), share):
                            linked.add(code[k])
                            found.append((names[j], names[k]))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(x, node.type) for x in zip(*found, strict=True)], ["u", "v"])

    kind = nodes.schema["node"].dataType
    return groups.select("key", "rows").mapInArrow(search, T.StructType([T.StructField("u", kind), T.StructField("v", kind)]))


def _links_of_ids(known: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links ``u, v`` from each id with several sets to the node of each of them."""
    name = F.struct("set_1", "set_2")
    several = known.groupBy("id").agg(F.min(name).alias("least"), F.max(name).alias("most")).where("least <> most").select("id")
    sets = known.select("id", "set_1", "set_2").join(materialise(several, "ids-of-several-sets"), "id").distinct()
    return sets.join(nodes.select("set_1", "set_2", "node"), ["set_1", "set_2"]).select(F.col("id").alias("u"), F.col("node").alias("v")).where("u <> v")


def near_duplicates(
    docs: DataFrame, shingle: int = 5, share: int = SHARE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, text_hash, n_shingles, component`` per row of ``docs``.

    Words are runs of characters other than blank and ``\\t`` to ``\\r``, A-Z taken as a-z. Two
    documents are linked if their sets of ``shingle``-word runs share at least ``share`` percent;
    the component is the smallest id reachable over links. A null or empty text has no set and no
    links. Rows that repeat an id are one document with the links of all its texts. A null id is
    left alone: its component is null. Other columns are ignored; an empty table gives no rows.
    Bands and the agreement asked of signatures follow from ``share``; under 8 percent it is refused.
    """
    rows = materialise(sketches(docs, shingle, id_col, text_col, rows_for(share)), "sketches")
    known = rows.where("n_shingles > 0 AND id IS NOT NULL")
    classes = known.groupBy("set_1", "set_2").agg(F.min(F.struct("id", "text_hash", "n_shingles", "minima", "bands")).alias("c"))
    nodes = materialise(
        classes.select("set_1", "set_2", F.col("c.id").alias("node"), "c.text_hash", "c.n_shingles", "c.minima", "c.bands"), "nodes"
    )
    keys = nodes.select("node", F.explode("bands").alias("key"))
    buckets = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = materialise(keys.join(buckets, "key"), "shared-buckets")
    company = shared.groupBy("node").agg(F.sum("n").alias("company"))
    ranked = shared.join(company, "node")
    pivots = ranked.groupBy("key").agg(F.max_by("node", F.struct("company", F.hash("node"), "node")).alias("v"))
    pairs = shared.select("key", F.col("node").alias("u")).join(pivots, "key").where("u <> v").select("u", "v").distinct()
    likely = materialise(_agreeing(pairs, nodes, share), "likely-links")

    text = F.coalesce(F.col(text_col), F.lit(""))
    named = docs.select(F.col(id_col).alias("node"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    wanted = shared.select("node").distinct().join(nodes.select("node", "text_hash"), "node")
    texts = materialise(named.join(wanted.distinct(), ["node", "text_hash"]), "bucket-texts")

    links = materialise(_confirmed(likely, texts, shingle, share).unionByName(_links_of_ids(known, nodes)), "confirmed-links")
    labels = materialise(connected_components(links), "components")
    last = materialise(_block_links(shared, nodes, labels, texts, shingle, share), "block-links")
    if not last.isEmpty():
        known = labels.select(F.col("node").alias("u"), F.col("component").alias("v"))
        labels = materialise(connected_components(known.unionByName(last)), "components")

    of_set = materialise(
        nodes.select("set_1", "set_2", "node")
        .join(labels, "node", "left")
        .select("set_1", "set_2", F.coalesce("component", "node").alias("component")),
        "set-components",
    )
    slim = rows.select("id", "text_hash", "n_shingles", "set_1", "set_2")
    linked = slim.where("set_1 IS NOT NULL").join(of_set, ["set_1", "set_2"], "left")
    alone = slim.where("set_1 IS NULL").withColumn("component", F.col("id"))
    return linked.unionByName(alone, allowMissingColumns=True).select(
        "id", "text_hash", "n_shingles", F.when(F.col("id").isNotNull(), F.col("component")).alias("component")
    )


def drop_near_duplicates(
    docs: DataFrame, shingle: int = 5, share: int = SHARE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their component, with all their columns.

    Of rows with equal id (nulls alike) and equal text one stays: where other columns differ, the
    one whose columns as JSON have the smallest hash. Null ids with unlike texts all stay.
    """
    found = near_duplicates(docs, shingle, share, id_col, text_col)
    kept = found.where(F.col("id").eqNullSafe(F.col("component"))).select(F.col("id").alias("of_id"), F.col("text_hash").alias("of_text_hash"))
    kept = materialise(kept.groupBy("of_id", "of_text_hash").agg(F.count("*").alias("of_n")), "kept")
    # Carried columns travel in one struct, so that no name of theirs can clash.
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"))
    same = F.col("id").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_text_hash"))
    several = kept.where("of_n > 1")
    if several.isEmpty():
        out = rows.join(kept, same, "left_semi").select("row")
    else:
        again = rows.join(several, same, "left_semi").select("row", "id", F.col(f"row.`{text_col}`").alias("text"))
        one = again.groupBy("id", "text").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row")).select("row")
        out = rows.join(kept.where("of_n = 1"), same, "left_semi").select("row").unionByName(one)
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
