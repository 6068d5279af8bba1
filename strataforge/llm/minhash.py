"""Near-duplicates by one-permutation hashing.

One hash per shingle fills ``BINS`` bins with their minima; empty bins borrow
by optimal densification (each empty bin probes bins in an order of its own,
the same for all documents, until it meets a filled one). ``ROWS`` bins make
a band. Documents with equal shingle sets are one candidate; the others meet
in band buckets. A bucket does not emit pairs but a star: its most connected
member against the rest. Every candidate edge is confirmed on the full
shingle sets. Where members of a bucket are then still in different
components, the pairs between components are confirmed too, so no link is
lost to the star shape: one by one in buckets with few such pairs, and block
against block in crowded ones, where only a spanning forest leaves a block.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataforge.llm.arrays import Rolling, Texts, Words, mix, run_starts, signed
from strataforge.llm.common import id_text, packed
from strataforge.llm.components import components
from strataforge.session import ensure_checkpoint_dir

SHINGLE = 5
#: Similarity in hundredths.
THRESHOLD = 75
BINS, ROWS = 128, 4
BANDS = BINS // ROWS
#: Remaining pairs per member up to which a bucket's are listed; the members of others are compared in blocks.
LISTED = 8
#: Members and shingles of a part of a crowded bucket (a block is two parts).
PART, PART_SHINGLES = 1024, 1 << 20
#: Places over which the members of one crowd are spread in a join.
SALT = 64
#: Sets up to which a shingle is counted pair by pair, and columns of a 0-1 matrix.
RARE, WIDE = 24, 8192
#: Members confirmed against one copy of their centre.
STAR = 256
_KEEP = np.uint64((1 << 48) - 1)
_EMPTY = np.uint64(2**64 - 1)
#: Probing order of every bin: row j holds the bins that bin j asks, in order.
_PROBES = np.argsort(mix(np.arange(BINS * BINS, dtype=np.uint64) + np.uint64(77)).reshape(BINS, BINS), axis=1)


def shingle_sets(texts: Texts, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every document as one sorted array of
    (document << 48 | 48-bit hash), and each document's set size. With fewer
    than k words the whole sequence is one shingle; without words, none."""
    w = Words(texts, lower=True)
    at, h = w.grams(k)
    doc = w.doc[at]
    short = np.flatnonzero((w.counts > 0) & (w.counts < k))
    if len(short):
        whole = Rolling(w.hashes).of(w.first[short], w.first[short] + w.counts[short])
        doc, h = np.concatenate([doc, short]), np.concatenate([h, whole])
    keys = np.sort((doc.astype(np.uint64) << np.uint64(48)) | (h & _KEEP))
    keys = keys[run_starts(keys)]
    return keys, np.bincount((keys >> np.uint64(48)).astype(np.int64), minlength=texts.n)


def signatures(keys: np.ndarray, n: int) -> np.ndarray:
    """Densified one-permutation signatures (n x BINS) of shingle sets; empty sets stay empty."""
    doc = (keys >> np.uint64(48)).astype(np.int64)
    bins = ((keys & _KEEP) * np.uint64(BINS) >> np.uint64(48)).astype(np.int64)
    first = run_starts(doc, bins)  # sorted, so the first of a run is its minimum
    sig = np.full((n, BINS), _EMPTY, np.uint64)
    sig[doc[first], bins[first]] = keys[first] & _KEEP
    filled = sig != _EMPTY
    row, col = np.nonzero(~filled & filled.any(1)[:, None])
    for t in range(BINS):
        if not len(row):
            break
        ask = _PROBES[col, t]
        ok = filled[row, ask]
        sig[row[ok], col[ok]] = sig[row[ok], ask[ok]]
        row, col = row[~ok], col[~ok]
    return sig


def band_keys(sig: np.ndarray) -> np.ndarray:
    """(n x BANDS) bucket keys."""
    out = np.zeros((len(sig), BANDS), np.uint64)
    for r in range(ROWS):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + sig[:, r::ROWS])
    return mix(out + np.arange(BANDS, dtype=np.uint64))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, hi, t in Texts.of(b.column(1)).slices():
            keys, size = shingle_sets(t)
            h = mix(keys & _KEEP)
            ends = np.concatenate([[0], np.cumsum(size)])
            whole = [np.diff(np.concatenate([[np.uint64(0)], np.cumsum(x)])[ends]) for x in (h, mix(h ^ np.uint64(0xABCDEF)))]
            bands = signed(band_keys(signatures(keys, t.n)).reshape(-1))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(lo, hi - lo), pa.array(size, pa.int64()), pa.array(signed(whole[0])),
                 pa.array(signed(whole[1])), pa.ListArray.from_arrays(pa.array(np.arange(t.n + 1) * BANDS, pa.int32()), pa.array(bands))],
                ["doc_id", "n", "set_a", "set_b", "bands"])


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n, set_a, set_b, bands): set size, 128-bit set digest, band keys."""
    return docs.mapInArrow(_sketch, "doc_id long, n long, set_a long, set_b long, bands array<long>")


def _sets(column) -> list[np.ndarray]:
    out = []
    for _, _, t in Texts.of(column).slices():
        keys, size = shingle_sets(t)
        out += np.split(keys & _KEEP, np.cumsum(size)[:-1])
    return out


def apart(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the symmetric difference of two sorted sets."""
    if not len(a) or not len(b):
        return len(a) + len(b)
    at = np.searchsorted(a, b)
    return len(a) + len(b) - 2 * int(np.sum(a[np.minimum(at, len(a) - 1)] == b))


def _confirm_star(key, centre: pa.Table, members: pa.Table) -> pa.Table:
    one = _sets(centre.column("text"))
    sets = _sets(members.column("text"))
    size = len(sets) if one else 0
    return pa.table([pa.array([key[0].as_py()] * size, pa.int64()), members.column("b").slice(0, size),
                     pa.array([apart(one[0], x) for x in sets[:size]], pa.int64())], ["a", "b", "apart"])


def confirm(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """(a, b, apart): the symmetric difference of the full shingle sets. Pairs
    are dealt by (centre, part) with at most about ``STAR`` members each, so a
    popular centre is split; its text travels once per part."""
    parts = pairs.groupBy("a").agg(F.count("*").alias("members"))
    dealt = (pairs.join(parts, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.ceil(F.col("members") / STAR))))
    centres = (dealt.select("a", "part").distinct().join(docs.withColumnRenamed("doc_id", "a"), "a")
               .select(F.col("a").alias("a"), F.col("part").alias("part"), F.col("text").alias("text")))
    members = (dealt.hint("shuffle_hash").join(docs.withColumnRenamed("doc_id", "b"), "b")
               .select("a", "part", "b", F.col("text").alias("text")))
    return (centres.groupBy("a", "part").cogroup(members.groupBy("a", "part"))
            .applyInArrow(_confirm_star, "a long, b long, apart long"))


def _rest(met: DataFrame, places: int) -> tuple[DataFrame, DataFrame]:
    """(a, b) of members of one bucket in different components, and the members
    (bucket, id, n, component) of the crowded buckets. ``off`` is how far a
    member is from the bucket's centre; symmetric differences obey the triangle
    inequality, so two members whose distances to the centre differ by more
    than a linked pair may be apart are not linked and not listed. A bucket is
    crowded when it has more than ``LISTED`` pairs per member. ``places`` are
    the rows of ``met``."""
    of_one = packed(met.groupBy("bucket", "component").agg(F.count("*").alias("k")), places)
    sizes = (of_one.groupBy("bucket").agg(F.sum("k").alias("size"), F.sum(F.col("k").cast("double") * F.col("k")).alias("within"))
             .withColumn("across", (F.col("size") * F.col("size") - F.col("within")) / 2).where("across > 0")
             .select("bucket", (F.col("across") <= F.col("size") * LISTED).alias("few")))
    met = packed(met.select("bucket", "id", "n", "component", "off").join(packed(sizes, places), "bucket"), places).checkpoint()
    few = met.where("few")
    x = few.select("bucket", F.col("id").alias("a"), F.col("n").alias("cn"), F.col("component").alias("cc"), F.col("off").alias("coff"))
    near = f"abs(off - coff) * {100 + THRESHOLD} <= (n + cn) * {100 - THRESHOLD}"
    pairs = (x.join(few, "bucket").where(f"a < id AND cc <> component AND {_fits()} AND coalesce({near}, true)")
             .select("a", F.col("id").alias("b")))
    return packed(pairs, places * LISTED), met.where("NOT few").select("bucket", "id", "n", "component")


def shared(sets: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all pairs of sorted sets. Elements of up to ``RARE``
    sets are counted pair by pair, the others by products of 0-1 matrices."""
    m = len(sets)
    h, doc = np.concatenate(sets), np.repeat(np.arange(m), [len(x) for x in sets])
    order = np.argsort(h, kind="stable")
    h, doc = h[order], doc[order]
    times = np.diff(np.append(run_starts(h), len(h)))
    col, each = np.repeat(np.arange(len(times)), times), np.repeat(times, times)
    out = np.zeros(m * m, np.int32)
    rare = (each > 1) & (each <= RARE)
    d, c = doc[rare], col[rare]
    for o in range(1, RARE):
        at = np.flatnonzero(c[o:] == c[:-o])
        if not len(at):
            break
        np.add.at(out, d[at] * m + d[at + o], 1)
    out = out.reshape(m, m)
    out = out + out.T
    d, c = doc[each > RARE], np.repeat(np.arange(np.sum(times > RARE)), times[times > RARE])
    for lo in range(0, int(c[-1]) + 1 if len(c) else 0, WIDE):
        use = slice(*np.searchsorted(c, [lo, lo + WIDE]))
        x = np.zeros((m, WIDE), np.float32)
        x[d[use], c[use] - lo] = 1
        out += (x @ x.T).astype(np.int32)
    np.fill_diagonal(out, [len(x) for x in sets])
    return out


def _link_block(key, rows):
    sets = _sets(rows.column("text"))
    n = np.array([len(x) for x in sets])
    both = n[:, None] + n[None, :]
    linked = (both - 2 * shared(sets)) * (100 + THRESHOLD) <= both * (100 - THRESHOLD)
    names, c = np.unique(rows.column("component").to_numpy(), return_inverse=True)
    i, j = np.nonzero(linked & (c[:, None] < c[None, :]))
    up, out = list(range(len(names))), []
    for code in np.unique(c[i] * len(names) + c[j]).tolist():
        ends = []
        for x in divmod(code, len(names)):
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            ends.append(x)
        if ends[0] != ends[1]:
            up[ends[1]] = ends[0]
            out.append(ends)
    at = np.array(out, np.int64).reshape(-1, 2)
    return pa.table([pa.array(names[at[:, 0]], pa.int64()), pa.array(names[at[:, 1]], pa.int64())], ["a", "b"])


def _spread(members: DataFrame, per_key: DataFrame, keys: list[str]) -> DataFrame:
    """Join one row per key onto members, each key dealt over ``SALT`` places."""
    every = per_key.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))))
    return members.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALT))).join(every, [*keys, "salt"]).drop("salt")


def crowd_links(crowded: DataFrame, text: DataFrame, places: int) -> DataFrame:
    """(a, b): components that are linked through members of one crowded bucket.

    All members of a bucket are compared on their full shingle sets, in blocks
    of two parts of about ``PART`` members, one task each; a block returns a
    spanning forest of its links. Buckets that share members are compared as
    one crowd where that is fewer pairs than bucket by bucket. ``places`` is a
    bound of the rows of ``crowded``, by which tables without texts are dealt.
    """
    heads = packed(crowded.groupBy("bucket").agg(F.min("id").alias("head"), F.count("*").cast("double").alias("size")), places).checkpoint()
    crowd = (components(crowded.join(heads, "bucket").select(F.col("id").alias("a"), F.col("head").alias("b")), rows=places)
             .select("id", F.col("component").alias("crowd")).checkpoint())
    apiece = (heads.join(crowd, F.col("head") == F.col("id")).groupBy("crowd")
              .agg(F.sum(F.col("size") * F.col("size")).alias("pairs")))
    apiece = packed(apiece, places)
    whole = (crowd.groupBy("crowd").agg(F.count("*").cast("double").alias("m")).join(apiece, "crowd")
             .select("crowd", (F.col("m") * F.col("m") <= F.col("pairs")).alias("whole")))
    whole = packed(whole, places)
    members = (_spread(packed(crowded.join(crowd, "id"), places), whole, ["crowd"])
               .select("whole", F.when(F.col("whole"), F.col("crowd")).otherwise(F.col("bucket")).alias("unit"), "id", "n", "component")
               .distinct())
    members = packed(members, places).checkpoint()
    parts = members.groupBy("whole", "unit").agg(
        F.ceil(F.greatest(F.count("*") / F.lit(PART), F.sum("n") / F.lit(PART_SHINGLES))).alias("parts"))
    dealt = (_spread(members, packed(parts, places), ["whole", "unit"])
             .select("whole", "unit", "id", "component", "parts", F.pmod(F.xxhash64("id", F.lit(PART)), F.col("parts")).alias("part")))
    rows = (dealt.join(text.withColumnRenamed("doc_id", "id"), "id")
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("parts") - 2, F.lit(0).cast("long")))))
            .withColumn("other", F.col("other") + (F.col("other") >= F.col("part")).cast("long"))
            .select("whole", "unit", F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y"), "component", "text"))
    return rows.groupBy("whole", "unit", "x", "y").applyInArrow(_link_block, "a long, b long")


def linked_pairs(tested: DataFrame, sizes: DataFrame) -> DataFrame:
    """(a, b) with 100 * intersection >= THRESHOLD * union, written with the symmetric difference and the set sizes."""
    pa_, pb = (sizes.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}")) for x in ("a", "b"))
    both = tested.join(pa_, "a").join(pb, "b")
    return both.where(f"apart * {100 + THRESHOLD} <= (n_a + n_b) * {100 - THRESHOLD}").select("a", "b")


def _fits() -> str:
    """The set sizes alone allow the threshold."""
    return f"100 * least(cn, n) >= {THRESHOLD} * greatest(cn, n)"


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Words are lower-cased A-Z; shingles are five words. Null, empty and
    wordless texts have no shingles and link with nothing. Documents with
    equal shingle sets are linked. Rows that repeat an id get equal results;
    the text read for an id is that of any of its rows.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    text = id_text(docs, id_col, text_col)
    sk = sketches(text).checkpoint()
    rows = sk.count()
    classes = packed(sk.where("n > 0").groupBy("set_a", "set_b", "n").agg(
        F.min("doc_id").alias("rep"), F.first("bands").alias("bands")), rows * BANDS).checkpoint()
    wide = classes.select(F.col("rep").alias("id"), "n", F.posexplode("bands").alias("at", "bucket"))
    shared = wide.groupBy("bucket").count().where("count > 1")
    met = packed(wide.join(shared, "bucket"), rows * BANDS).checkpoint()
    places = met.count()
    weight = met.groupBy("id").agg(F.sum("count").alias("weight"))
    met = packed(met.drop("count").join(weight, "id"), places).checkpoint()
    # the texts of documents that share a bucket, moved once and read by both confirmations
    met_text = text.join(weight.select(F.col("id").alias("doc_id")).hint("shuffle_hash"), "doc_id", "left_semi").checkpoint()
    heads = (met.groupBy("bucket").agg(F.max(F.struct("weight", (-F.col("id")).alias("least"), F.col("n").alias("cn"))).alias("c"))
             .select("bucket", (-F.col("c.least")).alias("a"), "c.cn"))
    heads = packed(heads, places)
    star = packed(met.join(heads, "bucket").where(f"a <> id AND {_fits()}").select("a", F.col("id").alias("b")), places)
    star = packed(star.distinct(), places).checkpoint()
    sizes = classes.select(F.col("rep").alias("id"), "n")
    tested = packed(confirm(star, met_text).checkpoint(), places)
    links = packed(linked_pairs(tested, sizes), places).checkpoint()
    comp = components(links, rows=places).checkpoint()
    met = packed(met.join(comp, "id", "left").withColumn("component", F.coalesce("component", "id")), places)
    met = (packed(met.join(heads.select("bucket", "a"), "bucket"), places)
           .join(tested.select("a", F.col("b").alias("id"), F.col("apart").alias("off")), ["a", "id"], "left")
           .withColumn("off", F.when(F.col("a") == F.col("id"), 0).otherwise(F.col("off"))))
    pairs, crowded = _rest(packed(met, places).checkpoint(), places)
    rest = (pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
            .join(star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), ["a", "b"], "left_anti"))
    rest = packed(rest, places * LISTED).checkpoint()
    more = [] if rest.isEmpty() else [linked_pairs(confirm(rest, met_text), sizes)]
    more += [] if crowded.isEmpty() else [crowd_links(crowded, met_text, places)]
    if more:
        more = reduce(DataFrame.unionByName, more).checkpoint()
        more = packed(more, places)
        if found := more.count():
            # the components found so far stand for their links
            comp = components(comp.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(more), rows=places + found)
    reps = packed(classes.join(comp.withColumnRenamed("id", "rep"), "rep", "left").select(
        "set_a", "set_b", "n", F.coalesce("component", "rep").alias("component_id")), rows)
    linked = sk.where("n > 0").select("doc_id", "set_a", "set_b", "n").join(reps, ["set_a", "set_b", "n"])
    linked = packed(linked.select("doc_id", "n", "component_id"), rows)
    out = linked.unionByName(sk.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                      (F.col("doc_id") == F.col("component_id")).alias("kept"))


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay (one document per component), with all their columns."""
    gone = near_duplicates(docs, id_col, text_col).where("NOT kept").select(F.col("doc_id").alias(id_col)).distinct()
    return docs.where(F.col(id_col).isNotNull()).join(gone.hint("shuffle_hash"), id_col, "left_anti").select(docs.columns)
