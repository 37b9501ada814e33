"""N-gram Jaccard join with parity sketches.

Every distinct shingle flips one bit of a wide sketch that is divided into segments, so the Hamming
distance of two sketches is at most the sets' symmetric difference. At Jaccard 0.8 that difference is at
most (n_a + n_b) / 9: within a band of sizes, at most d segments of two linked documents differ. Each
document hands on its first d + slack non-empty segments; linked documents then have at least ``slack``
of them in common, so each may drop all but one of that number of its most frequent ones (pigeonhole).
Equal segments give candidates, sketches of parity bits thin them out, whole shingle sets decide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from greenlake.llm.common import bitmap_of, connected_components, map_batches, with_component_id, written
from greenlake.llm.hashing import SPACE, byte_ranges, mix, pieces

WORDS = 5
_S32 = np.uint64(32)
#: Odd factors of a shingle's words by place.
_PLACE = np.random.default_rng(6).integers(1, 1 << 63, WORDS).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def _word_hashes(said: bytes) -> np.ndarray:
    b = np.frombuffer(said, np.uint8)
    space = np.ones(len(b) + 2, bool)
    space[1:-1] = SPACE[b]
    ends = np.flatnonzero(space[1:] != space[:-1])
    return byte_ranges(b, ends[::2], ends[1::2])


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's five-word shingles (A-Z lower-cased, ASCII white space)."""
    said = text.encode("utf-8", "replace").lower() if text else b""
    parts = [_word_hashes(piece) for _, piece in pieces(said)]
    x = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    if not len(x):
        return x
    size = min(WORDS, len(x))
    h = np.full(len(x) - size + 1, size, np.uint64)
    for k in range(size):
        h += x[k : len(x) - size + 1 + k] * _PLACE[k]
    h = np.sort(mix(h))
    return h[np.concatenate([[True], h[1:] != h[:-1]])]


def class_of(sh: np.ndarray) -> int:
    """A 64-bit name of a shingle set; equal sets are one class."""
    return xxhash.xxh3_64_intdigest(sh.tobytes()) - (1 << 63)


def _bands(n: int):
    """(band, upper size, most differing segments) of the bands that a set of n shingles takes part in."""
    if n < 4:
        return  # no different set is similar enough
    band = max(2, (n - 1).bit_length())
    top, partner = 1 << band, n * 5 // 4
    yield band, top, (n + min(partner, top)) // 9
    if partner > top:
        yield band + 1, 2 * top, (n + partner) // 9


#: Least and most bytes of a sketch; in between there are 16 bits for each shingle that a band's sets may have,
#: and four in the brief one that goes along with pairs.
SKETCH_LEAST, SKETCH_BYTES = 16, 2048
#: Buckets up to this size are paired by a join; larger ones are compared in blocks of BLOCK.
SMALL, BLOCK = 32, 1024


def slack_of(band: int) -> int:
    return 1 + (3 << band) // 100


def sketch_of(sh: np.ndarray, band: int, top: int) -> bytes:
    bits = 8 * min(max(2 * top, SKETCH_LEAST), SKETCH_BYTES)
    at = (mix(sh + np.uint64(band)) >> np.uint64(8)) % np.uint64(bits)
    return np.packbits(np.bincount(at.astype(np.int64), minlength=bits) % 2 == 1).tobytes()


def brief_of(sketch: bytes, top: int) -> bytes:
    """The sketch folded to fewer bits, in which two differ in no more of them."""
    width = min(max(top // 2, SKETCH_LEAST), SKETCH_BYTES)
    return np.bitwise_xor.reduce(np.frombuffer(sketch, np.uint8).reshape(-1, width)).tobytes()


def segments(sh: np.ndarray, with_sketch: bool = True):
    """(band, slack, segment names, sketch bytes) that a shingle set hands on.

    Each shingle flips one bit of the sketch, so two sketches differ in at most as many bits as their sets
    differ in shingles.
    """
    for band, top, d in _bands(len(sh)):
        count = -(-8 * top // 25) + 2
        slack = slack_of(band)
        seg = ((sh >> _S32) * np.uint64(count)) >> _S32
        bit = mix(sh ^ np.uint64(band))
        order = np.argsort(seg, kind="stable")
        seg, bit = seg[order], bit[order]
        starts = np.nonzero(np.concatenate([[True], seg[1:] != seg[:-1]]))[0]
        value, seg = np.bitwise_xor.reduceat(bit, starts), seg[starts]
        full = value != 0
        seg, value = seg[full], value[full]
        want = d + slack
        if len(seg) < want:  # small sets also hand on their empty segments
            bare = np.setdiff1d(np.arange(count, dtype=np.uint64), seg)
            seg, value = np.concatenate([seg, bare]), np.concatenate([value, np.zeros(len(bare), np.uint64)])
        else:
            seg, value = seg[:want], value[:want]
        names = mix(value ^ mix(seg * np.uint64(64) + np.uint64(band))).view(np.int64)
        yield band, slack, names, sketch_of(sh, band, top) if with_sketch else b""


def _segment_rows(docs: DataFrame, text_col: str) -> DataFrame:
    def make():
        def fn(texts):
            names, classes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for text in texts:
                sh = shingles(text)
                if len(sh):
                    c = class_of(sh)
                    for _, _, s, _ in segments(sh, False):
                        names.append(s)
                        classes.append(np.full(len(s), c))
            return pa.array(np.concatenate(names)), pa.array(np.concatenate(classes))

        return fn

    return map_batches(docs.select(text_col), make, "segment bigint, class bigint")


def _marked(df: DataFrame, column: str, max_bits: int, each: int):
    """A broadcast bitmap of the values of a long column, and the power of two that is its number of bits.

    There are ``each`` bits or more for a value, but ``2**max_bits`` at most: more values than that allows
    share bits, so it marks others too, but never misses one.
    """
    bits = max(16, min(max_bits, (each * df.count()).bit_length()))
    return df.sparkSession.sparkContext.broadcast(bitmap_of(df, column, bits)), bits


def _hits(table: np.ndarray, bits: int, values: np.ndarray) -> np.ndarray:
    at = values & ((1 << bits) - 1)
    return (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _candidates(docs: DataFrame, shared: DataFrame, id_col: str, text_col: str, max_bits: int) -> DataFrame:
    """One row for each document: its class, and for each band its segments that may be shared.

    A bitmap of the shared segments thins out the others; the join with the shared segments does the rest.
    Neither sets nor sketches are handed on here. ``key`` names the row, so that they can be made again for few.
    """
    sent, bits = _marked(shared, "segment", max_bits, 16)
    kind = docs.schema[id_col].dataType.simpleString()

    def make():
        table, done = np.frombuffer(sent.value, np.uint8), set()

        def fn(ids, texts, keys):
            sizes, classes, bands = [], [], []
            if len(done) > 1_000_000:
                done.clear()
            for text in texts:
                sh = shingles(text)
                sizes.append(len(sh))
                c = class_of(sh) if len(sh) else None
                classes.append(c)
                own = []
                if c is not None and c not in done:
                    for band, slack, s, _ in segments(sh, False):
                        hit = s[_hits(table, bits, s)]
                        if len(hit) >= slack:
                            own.append({"band": band, "slack": slack, "segments": hit})
                    done.add(c)
                bands.append(own)
            return ids, sizes, classes, [k if own else None for k, own in zip(keys, bands)], bands

        return fn

    return map_batches(
        docs.select(id_col, text_col, F.xxhash64(id_col, text_col)), make,
        f"id {kind}, n int, class bigint, key bigint, bands array<struct<band: int, slack: int, segments: array<bigint>>>",
    )


def _sets(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str, max_bits: int) -> DataFrame:
    """The class, sketches and shingle set of each row of one of the keys, of some other rows too; classes may be repeated."""
    sent, bits = _marked(keys, "key", max_bits, 64)

    def make():
        table, done = np.frombuffer(sent.value, np.uint8), set()

        def fn(names, texts):
            classes, bands, sets = [], [], []
            if len(done) > 1_000_000:
                done.clear()
            for i in np.flatnonzero(_hits(table, bits, np.array(names, np.int64))):
                sh = shingles(texts[i])
                c = class_of(sh) if len(sh) else None
                if c is not None and c not in done:
                    done.add(c)
                    classes.append(c)
                    own = [(band, top, sketch_of(sh, band, top)) for band, top, _ in _bands(len(sh))]
                    bands.append([{"band": band, "size": len(sh), "sketch": s, "brief": brief_of(s, top)} for band, top, s in own])
                    sets.append(sh.tobytes())
            return classes, bands, sets

        return fn

    return map_batches(
        docs.select(F.xxhash64(id_col, text_col), text_col), make,
        "class bigint, bands array<struct<band: int, size: int, sketch: binary, brief: binary>>, shingles binary",
    )


def _compared(rows: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs of a bucket's classes of different components whose sketches differ in few enough bits.

    Buckets are cut into blocks by their counted sizes, and each pair of blocks is a group of bounded size;
    only pairs that the sketches' bound lets pass are handed on.
    """
    x = rows.join(sketches.select("class", "band", "sketch").hint("merge"), ["class", "band"]).withColumn("blocks", F.ceil(F.col("bucket") / BLOCK).cast("int"))
    x = x.withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    x = x.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    x = x.withColumns({"b0": F.least("own", "other"), "b1": F.greatest("own", "other")})
    x = x.select("segment", "b0", "b1", "own", "band", "class", "size", "component", "sketch")

    def compare(key, batch):
        b0, b1 = key[1].as_py(), key[2].as_py()
        names, sizes = batch["class"].to_numpy(), batch["size"].to_numpy().astype(np.int64)
        groups, own = batch["component"].to_numpy(), batch["own"].to_numpy()
        sketch = np.frombuffer(b"".join(batch["sketch"].to_pylist()), np.uint64).reshape(len(names), -1)
        kinds, n = np.unique(groups, return_counts=True)
        major = kinds[np.argmax(n)]
        out_a, out_b = [], []
        for i in np.nonzero(groups != major)[0]:  # of two components one is not the most common
            there = (groups != groups[i]) & ((groups == major) | (names > names[i]))
            if b0 != b1:
                there &= own != own[i]
            low, high = np.minimum(sizes, sizes[i]), np.maximum(sizes, sizes[i])
            at = np.nonzero(there & (low * 100 >= high * percent))[0]
            if len(at):
                far = np.bitwise_count(sketch[at] ^ sketch[i]).sum(1, dtype=np.int64)
                at = at[far * (100 + percent) <= (sizes[at] + sizes[i]) * (100 - percent)]
                out_a.append(np.minimum(names[at], names[i]))
                out_b.append(np.maximum(names[at], names[i]))
        none = np.zeros(0, np.int64)
        a, b = np.concatenate([none, *out_a]), np.concatenate([none, *out_b])
        return pa.table({"a": a, "b": b, "band": np.full(len(a), batch["band"][0].as_py(), np.int32)})

    return x.groupBy("segment", "b0", "b1").applyInArrow(compare, "a bigint, b bigint, band int")


def _near(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of the (a, b, band) of classes whose brief sketches differ in few enough bits."""

    def make():
        def fn(a, b, n_a, n_b, s_a, s_b):
            far = [int(np.bitwise_count(np.frombuffer(p, np.uint64) ^ np.frombuffer(q, np.uint64)).sum()) for p, q in zip(s_a, s_b)]
            few = [i for i, d in enumerate(far) if d * (100 + percent) <= (n_a[i] + n_b[i]) * (100 - percent)]
            return [a[i] for i in few], [b[i] for i in few]

        return fn

    brief = sketches.select("class", "band", "size", "brief")
    x = pairs.groupBy("a", "b").agg(F.min("band").alias("band"))
    x = x.join(brief.toDF("a", "band", "n_a", "s_a").hint("merge"), ["a", "band"])
    x = x.join(brief.toDF("b", "band", "n_b", "s_b").hint("merge"), ["b", "band"])
    return map_batches(x.select("a", "b", "n_a", "n_b", "s_a", "s_b"), make, "a bigint, b bigint")


def _verified(pairs: DataFrame, sketches: DataFrame, sets: DataFrame, percent: int, max_bits: int) -> DataFrame:
    """The pairs (a, b, band) of classes whose shingle sets are similar enough, as (a, b).

    Sketches go along with the pairs first; only sets of pairs that these let pass are shuffled.
    """
    near = written(_near(pairs, sketches, percent), "near")
    names = near.select(F.col("a").alias("class")).unionByName(near.select(F.col("b").alias("class"))).distinct()
    sent, bits = _marked(names, "class", max_bits, 64)

    def asked():
        table = np.frombuffer(sent.value, np.uint8)

        def fn(classes, held):
            at = np.flatnonzero(_hits(table, bits, np.array(classes, np.int64)))
            return [classes[i] for i in at], [held[i] for i in at]

        return fn

    def compare():
        def fn(a, b, s_a, s_b):
            sizes = [(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)) for p, q in zip(s_a, s_b)]
            both = [(len(np.intersect1d(p, q, assume_unique=True)), len(p) + len(q)) for p, q in sizes]
            at = [i for i, (n, of) in enumerate(both) if n * 100 >= (of - n) * percent]
            return [a[i] for i in at], [b[i] for i in at]

        return fn

    own = map_batches(sets.select("class", "shingles"), asked, "class bigint, shingles binary").dropDuplicates(["class"])
    x = near.join(own.toDF("a", "s_a").hint("merge"), "a").join(own.toDF("b", "s_b").hint("merge"), "b")
    return map_batches(x.select("a", "b", "s_a", "s_b"), compare, "a bigint, b bigint")


def similar_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 4, bits: int = 28
) -> DataFrame:
    """Every row's id, n_shingles and component_id under links of Jaccard 0.8 or more.

    Sets are of distinct five-word shingles; a shorter text is one shingle, and a null or blank one is an
    empty set that links with nothing and has its own id as component. component_id is the smallest id
    that links reach. Equal sets are one class, so copies are never paired. Each segment's classes are
    checked against one of them, up to ``rounds`` times while that joins many; then only classes that no
    chain of links has joined are paired with each other. Bitmaps take ``2**bits`` bits at most. Rows that share an id count as separate documents; null ids take part in
    links but are smallest only among themselves. Other columns are not read.
    """
    percent = 80  # the bands above are made for it
    all_segments = _segment_rows(docs, text_col).groupBy("segment").agg(
        F.count("*").alias("n"), F.min("class").alias("low"), F.max("class").alias("high")
    )
    shared = written(all_segments.where("low <> high").select("segment", "n"), "segments")
    rows = written(_candidates(docs, shared, id_col, text_col, bits), "documents")
    known = rows.where("key is not null").select("class", "n", "key", "bands").dropDuplicates(["class"])
    known = written(known, "classes")
    x = known.select("class", F.col("n").alias("size"), F.explode("bands").alias("b"))
    x = x.select("class", "size", F.col("b.band").alias("band"), F.col("b.slack").alias("slack"), F.explode("b.segments").alias("segment"))
    # Spark can't know how many rows an explode or a filter leaves, so nothing is broadcast after one.
    x = x.join(shared.hint("merge"), "segment")
    rarest = Window.partitionBy("class", "band").orderBy(F.desc("n"), "segment")
    x = x.withColumn("place", F.row_number().over(rarest)).where(F.col("place") >= F.col("slack"))
    x = written(x.select("segment", "band", "class", "size"), "prefixes")
    asked = x.select("class").distinct()
    keys = written(known.select("class", "key").join(asked.hint("merge"), "class").select("key"), "keys")
    total = keys.count()
    sets = written(_sets(docs, keys, id_col, text_col, bits), "sets")
    sketches = sets.select("class", F.explode("bands").alias("b")).select("class", "b.band", "b.size", "b.sketch", "b.brief")
    sketches = written(sketches.dropDuplicates(["class", "band"]), "sketches")

    alike = F.least("size", "r_size") * 100 >= F.greatest("size", "r_size") * percent

    def grouped(found, component):
        """Components after further links: only the links between components so far are worked on."""
        if component is None:
            return connected_components(found.select(F.col("a").alias("u"), F.col("b").alias("v")), "jaccard")
        of = component.select("id", "component")
        e = found.join(of.toDF("a", "u"), "a", "left").join(of.toDF("b", "v"), "b", "left")
        e = e.select(F.coalesce("u", "a").alias("u"), F.coalesce("v", "b").alias("v"))
        more = connected_components(e, "jaccard")
        old = of.join(more.toDF("component", "_to"), "component", "left").select("id", F.coalesce("_to", "component").alias("component"))
        return written(old.unionByName(more.join(of.select("id"), "id", "left_anti")), "jaccard-groups")

    component = None
    for r in range(rounds):
        if component is None:
            own = x.withColumn("component", F.col("class"))
        else:
            own = x.join(component, x["class"] == component["id"], "left").select(
                "segment", "band", "class", "size", F.coalesce("component", "class").alias("component")
            )
        pick = F.struct(F.xxhash64("class", F.lit(r)), "class", "size", "component")
        ends = own.groupBy("segment").agg(F.min(pick).alias("p"), F.min("component").alias("c0"), F.max("component").alias("c1"))
        ends = ends.where("c0 <> c1").select("segment", F.col("p.class").alias("r_class"), F.col("p.size").alias("r_size"), F.col("p.component").alias("r_component"))
        pairs = own.join(ends.hint("merge"), "segment").where(F.col("component") != F.col("r_component")).where(alike)
        pairs = pairs.select(F.least("class", "r_class").alias("a"), F.greatest("class", "r_class").alias("b"), "band")
        found = written(_verified(pairs, sketches, sets, percent, bits), "links")
        component = grouped(found, component)
        if found.count() * 20 < total:
            break  # few classes are joined this way; the rest is cheaper at once
    # What is left: classes that share a segment and that no chain of links has joined.
    own = x.join(component, x["class"] == component["id"], "left").select(
        "segment", "band", "class", "size", F.coalesce("component", "class").alias("component")
    )
    open_ = own.groupBy("segment").agg(F.min("component").alias("c0"), F.max("component").alias("c1"), F.count("*").alias("bucket"))
    own = written(own.join(open_.where("c0 <> c1").select("segment", "bucket").hint("merge"), "segment"), "open")
    small, large = own.where(F.col("bucket") <= SMALL), own.where(F.col("bucket") > SMALL)
    other = small.select("segment", F.col("class").alias("r_class"), F.col("size").alias("r_size"), F.col("component").alias("r_component"))
    pairs = small.join(other.hint("merge"), "segment").where("class < r_class and component <> r_component").where(alike)
    pairs = pairs.select(F.col("class").alias("a"), F.col("r_class").alias("b"), "band")
    pairs = pairs.unionByName(_compared(large, sketches, percent))
    component = grouped(written(_verified(pairs, sketches, sets, percent, bits), "links"), component)

    roots = rows.select("id", "n", "class").join(component.withColumnRenamed("id", "c_id"), F.col("class") == F.col("c_id"), "left")
    roots = roots.select("id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "class").alias("root"))
    out = with_component_id(roots)
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id")
