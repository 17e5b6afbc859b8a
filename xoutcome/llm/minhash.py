"""Near-duplicate classes: universal hash minima, banding, signature and exact verification, components.

The path of a document:

1. ``signatures``: distinct five-word shingles, ``ROWS * BANDS`` minima of universal hash functions, a key of the set.
2. Documents with equal sets are linked by that key; one of them stands for all from here on.
3. In each bucket of the first ``FIRST`` bands every member is paired with the least one (a star, not all pairs). Pairs
   whose signatures agree in ``AGREE`` places at least are confirmed on the full sets, and the confirmed links give
   components. Then the same over all bands, with one member for each component in a bucket: a large group, which
   would have other stars in every band, is one component by then.
   There are ``ROUNDS`` such rounds, further ones with other members, drawn by hash.
4. A bucket that still spans several components has members that were not compared. Only there, members of
   different components are compared by signature, in tiles of ``TILE`` x ``TILE`` inside tasks, which tell the members
   that have an agreeing one in another component, never the pairs. Tiles of these alone, with their full sets, confirm
   pairs and join components as they go, so that a tile returns fewer links than it has members.

With 4 rows and 32 bands a pair at the threshold shares no bucket with a chance of 5e-6, and less above it; two
signatures of such a pair agree in fewer than ``AGREE`` places with a chance of about 2e-6.

Texts that are null, empty or without words have no set and stay alone. Repeated ids are one document. Rows without an
id have no id that a class could be named after: their ``kept`` is null, and they hide or link no others. Any other
columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xoutcome.llm.common import column_bytes, texts
from xoutcome.llm.graph import connected_components
from xoutcome.llm.shingles import Shingler
from xoutcome.session import stored

ROWS, BANDS = 4, 32
FIRST = 4
AGREE = 72
TILE = 512
ROUNDS = 1
BROADCAST_IDS = 1_000_000
_SIGNED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()), ("sig", pa.binary())])


def _functions() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20_240_229)
    a = draw.integers(0, 1 << 63, ROWS * BANDS, np.uint64) * np.uint64(2) + np.uint64(1)
    return a, draw.integers(0, 1 << 63, ROWS * BANDS, np.uint64)


def minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each function x -> (a x + b mod 2^64) >> 32 its least value over the set."""
    low = np.full(len(a), np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(shingles), 1024):
        low = np.minimum(low, (shingles[at:at + 1024, None] * a + b).min(axis=0))
    return (low >> np.uint64(32)).astype("<u4")


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_key, sig) of every document; key and signature are null for an empty set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (a, b), shingler = _functions(), Shingler()
        for batch in batches:
            sizes, keys, signed = [], [], []
            for text in column_bytes(batch.column(1)):
                own = shingler.distinct(text)
                sizes.append(len(own))
                keys.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                signed.append(minima(own, a, b).tobytes() if len(own) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                                              pa.array(signed, pa.binary())], schema=_SIGNED)
    return docs.mapInArrow(run, "doc_id long, n_shingles long, set_key binary, sig binary")


def band_rows(signed: DataFrame) -> DataFrame:
    """(number, band, doc_id): one row per document and band; equal rows of a band have equal hashes."""
    width = 4 * ROWS
    keys = F.array(*[F.xxhash64(F.substring("sig", 1 + width * i, width), F.lit(i)) for i in range(BANDS)])
    return signed.select("doc_id", F.posexplode(keys).alias("number", "band"))


def star_pairs(bands: DataFrame, component: DataFrame | None = None, round_: int = 0) -> DataFrame:
    """Pairs (a, b) of a bucket's first member and the first member of each of its other components.

    First is the least id, in rounds above 0 the least hash of id and round.
    """
    first = F.min(F.struct(F.xxhash64("doc_id", F.lit(round_)) if round_ else F.lit(0).cast("long"), F.col("doc_id").alias("doc_id")))
    if component is None:
        least = bands.select("band", F.lit(0).cast("long").alias("by"), F.col("doc_id").alias("b"))
    else:
        least = _named(bands, component).groupBy("band", "component").agg(first.alias("first")).select(
            "band", F.col("first.col1").alias("by"), F.col("first.doc_id").alias("b"))
    heads = least.groupBy("band").agg(F.min(F.struct("by", "b")).alias("h"), F.count(F.lit(1)).alias("n")).where("n > 1").select(
        "band", F.col("h.b").alias("a"))
    pairs = least.join(heads, "band").where("a <> b")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _named(bands: DataFrame, component: DataFrame) -> DataFrame:
    return bands.join(component, bands["doc_id"] == component["node"], "left").select(
        "band", "doc_id", F.coalesce("component", "doc_id").alias("component"))


def agreeing(pairs: DataFrame, signed: DataFrame, least: int = AGREE) -> DataFrame:
    """The pairs (a, b) whose signatures have ``least`` equal minima or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), "<u4").reshape(-1, ROWS * BANDS) for k in (2, 3))
                yield batch.select([0, 1]).filter(pa.array((x == y).sum(axis=1) >= least))
    sig = signed.select("doc_id", "sig")
    rows = pairs.join(sig.select(F.col("doc_id").alias("a"), F.col("sig").alias("x")), "a").join(
        sig.select(F.col("doc_id").alias("b"), F.col("sig").alias("y")), "b")
    return rows.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def confirmed(pairs: DataFrame, docs: DataFrame, similarity: tuple[int, int] = (75, 100)) -> DataFrame:
    """The pairs (u, v) whose full shingle sets have the similarity, by integers: 100 * common >= 75 * union."""
    part, whole = similarity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            held: tuple[bytes, np.ndarray] = (b"", np.empty(0, np.uint64))
            keep = []
            for left, right in zip(column_bytes(batch.column(2)), column_bytes(batch.column(3))):
                if held[0] is not left and held[0] != left:
                    held = (left, shingler.distinct(left))
                x, y = held[1], shingler.distinct(right)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(bool(len(x)) and whole * common >= part * (len(x) + len(y) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
    ids = stored(pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct(), "ids")
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS  # 8 MB of ids at most; else a shuffled semi join
    own = docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")
    rows = pairs.join(own.select(F.col("doc_id").alias("b"), F.col("text").alias("y")), "b").join(
        own.select(F.col("doc_id").alias("a"), F.col("text").alias("x")), "a")
    return rows.select("a", "b", "x", "y").mapInArrow(run, "a long, b long").select(
        F.col("a").alias("u"), F.col("b").alias("v"))


def _tiles(members: DataFrame) -> DataFrame:
    """Members (band, doc_id, component) by tile (band, kind, i, j), with the part of the tile that they are in (``tile``).

    Most members of a bucket that spans components are of one of them, its base, and need not meet each other. So parts of
    the others meet parts of the base (kind 0) and each other (kind 1, i <= j): a base member is in as many tiles as the
    others have parts.
    """
    sizes = members.groupBy("band", "component").agg(F.count(F.lit(1)).alias("n")).groupBy("band").agg(
        F.max(F.struct("n", (-F.col("component")).alias("least"))).alias("base"), F.sum("n").alias("n"))
    parts = lambda n: F.ceil(n / TILE).cast("int")
    cut = members.join(sizes.select("band", (-F.col("base.least")).alias("base"), parts(F.col("base.n")).alias("q"),
                                    parts(F.col("n") - F.col("base.n")).alias("p")), "band")
    other = F.col("component") != F.col("base")
    own = F.pmod(F.xxhash64("doc_id"), F.when(other, F.col("p")).otherwise(F.col("q"))).cast("int")
    cut = cut.select("band", "doc_id", "component", other.alias("other"), own.alias("own"), "p", "q")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    of_base = cut.where("not other").select("band", "doc_id", "component", F.lit(0).alias("kind"), F.lit(0).alias("tile"), every("p").alias("i"), F.col("own").alias("j"))
    to_base = cut.where("other").select("band", "doc_id", "component", F.lit(0).alias("kind"), F.lit(1).alias("tile"), F.col("own").alias("i"), every("q").alias("j"))
    among = cut.where("other").select("band", "doc_id", "component", F.lit(1).alias("kind"), F.col("own").alias("tile"), every("p").alias("at")).select(
        "band", "doc_id", "component", "kind", "tile", F.least("tile", "at").alias("i"), F.greatest("tile", "at").alias("j"))
    return of_base.union(to_base).union(among)


def _spanning(bands: DataFrame, component: DataFrame) -> DataFrame:
    """(band, doc_id, component) of the buckets of three members or more that span components."""
    named = _named(bands, component)
    spans = named.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                      F.count(F.lit(1)).alias("n")).where("lo < hi and n > 2").select("band")
    return named.join(spans, "band")


def _others(group: pd.DataFrame, sig: np.ndarray, k: int, component: np.ndarray) -> np.ndarray:
    """Places of the members after ``k`` that are of another part, if the tile has two, and another component, and agree."""
    other = component[k + 1:] != component[k]
    if group["kind"].iat[0] == 0 or group["i"].iat[0] != group["j"].iat[0]:
        tile = group["tile"].to_numpy()
        other &= tile[k + 1:] != tile[k]
    at = k + 1 + np.flatnonzero(other)
    return at[(sig[at] == sig[k]).sum(axis=1) >= AGREE]


def _met(members: DataFrame, signed: DataFrame) -> DataFrame:
    """(band, doc_id) of the members with an agreeing one of another component in their bucket."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        sig = np.frombuffer(b"".join(group["sig"]), "<u4").reshape(-1, ROWS * BANDS)
        component, met = group["component"].to_numpy(), np.zeros(len(group), bool)
        for k in range(len(group)):
            at = _others(group, sig, k, component)
            met[at] = True
            met[k] |= len(at) > 0
        return group.loc[met, ["band", "doc_id"]]
    return _tiles(members).join(signed.select("doc_id", "sig"), "doc_id").groupBy("band", "kind", "i", "j").applyInPandas(run, "band long, doc_id long").distinct()


def _joined(members: DataFrame, signed: DataFrame, docs: DataFrame, similarity: tuple[int, int] = (75, 100)) -> DataFrame:
    """Confirmed links (u, v) that join all components of a tile that have one between them, fewer than its members."""
    part, whole = similarity

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingler.distinct(t).tobytes() for t in column_bytes(batch.column(1))], pa.binary())],
                                             names=["doc_id", "set"])

    def run(group: pd.DataFrame) -> pd.DataFrame:
        sig = np.frombuffer(b"".join(group["sig"]), "<u4").reshape(-1, ROWS * BANDS)
        own = [np.frombuffer(x, np.uint64) for x in group["set"]]
        component, ids, out = group["component"].to_numpy().copy(), group["doc_id"].to_numpy(), []
        for k in range(len(group)):
            for at in _others(group, sig, k, component).tolist():
                if component[at] == component[k]:
                    continue
                x, y = own[k], own[at]
                common = len(np.intersect1d(x, y, assume_unique=True))
                if whole * common >= part * (len(x) + len(y) - common):
                    out.append((int(ids[k]), int(ids[at])))
                    component[component == component[at]] = component[k]
        return pd.DataFrame(out, columns=["u", "v"]).astype("int64")
    ids = stored(members.select("doc_id").distinct(), "ids")
    own = docs.join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"]).mapInArrow(sets, "doc_id long, set binary")
    rows = _tiles(members).join(signed.select("doc_id", "sig"), "doc_id").join(own, "doc_id")
    return rows.groupBy("band", "kind", "i", "j").applyInPandas(run, "u long, v long").distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row; ``component_id`` is the least id that links reach."""
    docs = texts(df, id_col, text_col)
    all_signed = stored(signatures(docs), "signatures")
    equal = stored(all_signed.where("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("rep")), "equal")
    signed = stored(all_signed.where("sig is not null").join(
        equal.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").select("doc_id", "sig"), "representatives")

    bands = band_rows(signed)
    met = bands.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("band")
    bands = stored(bands.join(met, "band").select("number", "band", "doc_id"), "bands")  # buckets of two members or more

    def links_of(pairs: DataFrame) -> DataFrame:
        return stored(confirmed(stored(pairs, "pairs"), docs), "links")
    links = links_of(agreeing(star_pairs(bands.where(F.col("number") < FIRST)), signed))
    component = stored(connected_components(links), "components")
    for round_ in range(ROUNDS):
        new = links_of(agreeing(star_pairs(bands, component, round_), signed))
        if new.isEmpty():
            break
        links = links.union(new)
        component = stored(connected_components(links), "components")
    open_ = stored(_spanning(bands, component), "open")
    met = stored(_met(open_, signed), "met")
    if not met.isEmpty():
        links = links.union(stored(_joined(open_.join(met, ["band", "doc_id"], "left_semi"), signed, docs), "links"))
        component = connected_components(links)

    named = all_signed.select("doc_id", "n_shingles", "set_key").join(equal, "set_key", "left").withColumn(
        "rep", F.coalesce("rep", "doc_id"))
    return named.join(component, named["rep"] == component["node"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id")).withColumn(
        "kept", F.col("doc_id") == F.col("component_id"))
