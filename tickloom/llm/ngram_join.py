"""Documents whose sets of five-word shingles are alike, by partitioning the universe of shingles.

Two sets link when their Jaccard similarity reaches a threshold. Sets of sizes a and b then differ in at most
H = (a + b)(1 - t)/(1 + t) shingles. Sizes fall into bands that grow by ``RATIO``; a band cuts the universe of shingle hashes
into segments, about ``FINE`` for each shingle of its smallest sets. A set takes part in its own band, and in the next one if
partners may lie there. The segments in which it has shingles are its signatures. If there are N of them, it agrees with
any partner on N - H or more.

Which of them a set indexes is chosen by cost, the number of sets that hold a signature. All signatures are counted first.
One that no other set holds costs nothing and agrees with nobody: a set with more than H of these has no partner and goes.
Any other set that shares c of its signatures keeps the c - (N - H) + 1 rarest ones, because the rarest one on which two
linked sets agree is among those of both. Passages that many documents share are thus left out, unless they make up most of a
set. Sets with H segments or fewer (small ones whose shingles fall together) index more, and all of it:

* their *one-deletion neighbourhoods*: half as many segments, of which at least one then differs in one shingle at
  most, each with its signature and those of the segment without any one shingle;
* their *single shingles* where even that leaves too few segments with two shingles.

A set that needs such a form knows it from its own segments, and so does every partner that the cheaper form would miss.

A signature gives one candidate for each of its sets, to the smallest, verified on the whole sets. Sets that this leaves in
different components of one signature are compared once more by single shingles: those found in one component only
cost nothing, a set needs 3/7 of both sizes in others, and keeps the rarest that this allows for each band of sizes that
partners may have. Sets meet by these; sizes, shared shingles and parities of parts of the universe rule pairs out there.
They meet in rounds: of a group that shares a shingle a few pivots meet all others first, and what links with them becomes one
component. ``MORE`` times as many pivots follow while groups have sets of several components, so that a group whose
copies link costs a few pairs for each of them; only where none link, all pairs meet in the end.

Documents with equal sets are one vertex from the start. Components are exact, while copies are not expanded into all pairs.
Sets are known by 64 bits: about n^2 / 2^65 wrong links by chance among n different sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.components import components
from tickloom.llm.store import Steps, kept
from tickloom.llm.text import only, slices, text_key, text_of

SHINGLE, THRESHOLD = 5, 75  # words; hundredths
FIRST, RATIO, FINE = 3, 4, 2  # smallest set of the first band, growth of bands, segments per shingle of a band's smallest sets
HOT = (1 << 31) - 1  # cost of signatures that are too frequent to count in one pass; all the same
SKETCH_BITS = 512
PIVOTS, MORE = 4, 8  # sets of a group that meet all others in the first round; growth of their number by round
SIZE_STEPS = 40  # bands of size for the second comparison grow by e^(1/40)

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_STEPS = tuple(_U(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE, _U), np.full(n, pow(_BASE, -1, 1 << 64), _U)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=_U), np.cumprod(down, dtype=_U)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all texts, and the number of the text of each."""
    raw = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    inside = np.concatenate(([0], (~_SPACE[raw]).view(np.int8)))
    edge = np.diff(inside)
    starts = np.flatnonzero(edge == 1)
    ends = np.flatnonzero(edge == -1)
    up, down = _powers(1 << max(21, int(len(raw)).bit_length()))
    sums = np.concatenate((np.zeros(1, _U), np.cumsum((raw.astype(_U) + _U(1)) * up[: len(raw)], dtype=_U)))
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U) * _U(_BASE))
    return hashes, np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, "right")


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, of = word_hashes(texts)
    first = np.searchsorted(of, np.arange(len(texts) + 1))
    n = max(len(hashes) - SHINGLE + 1, 0)
    whole = mix(sum((hashes[k : n + k] * s for k, s in enumerate(_STEPS)), np.zeros(n, _U)))
    sets = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= SHINGLE:
            sets.append(np.unique(whole[a : b - SHINGLE + 1]))
        elif b > a:
            short = (hashes[a:b] * np.array(_STEPS[: b - a])).sum(keepdims=True, dtype=_U)
            sets.append(mix(short + _U(b - a)))
        else:
            sets.append(np.zeros(0, _U))
    return sets


def set_id(shingles: np.ndarray) -> int:
    """A signed 64-bit identifier of a set."""
    return int(mix(np.array([np.add.reduce(mix(shingles), dtype=_U) + _U(len(shingles))], _U)).view(np.int64)[0])


def most_different(a: int, b: int) -> int:
    """The most shingles in which linked sets of these sizes differ."""
    return (a + b) * (100 - THRESHOLD) // (100 + THRESHOLD)


def bands(n: int) -> list[tuple[int, int]]:
    """(number, smallest size) of the bands of a set of size n. Sets of less than three shingles link only with equal ones."""
    if n < FIRST:
        return []
    band, smallest = 0, FIRST
    while smallest * RATIO <= n:
        band, smallest = band + 1, smallest * RATIO
    following = [(band + 1, smallest * RATIO)] if n * 100 // THRESHOLD >= smallest * RATIO else []
    return [(band, smallest), *following]


def _segments(shingles: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number, first index and sum of the segments with shingles; sorted hashes fall into segments in order."""
    segment = ((shingles >> _U(32)) * _U(m)) >> _U(32)
    starts = np.concatenate(([0], np.flatnonzero(np.diff(segment)) + 1))
    return segment[starts], starts, np.add.reduceat(shingles, starts)


def signatures(shingles: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
    """(parity, agreeing, signatures) for each band: at least so many signatures agree with any partner's.

    The lowest bit of a signature is its band's parity, which tells the two bands of a set apart.
    """
    n, out = len(shingles), []
    different = most_different(n, n * 100 // THRESHOLD)
    for band, smallest in bands(n):
        tags = [np.array([band * 3 + kind], _U) * _STEPS[0] for kind in (1, 2, 3)]
        segment, _, sums = _segments(shingles, FINE * smallest)
        found = [mix(sums + segment * _STEPS[1] + tags[0])]
        agreeing = len(segment) - different
        if agreeing <= 0:
            halved = max(1, FINE * smallest // 2)
            segment, starts, sums = _segments(shingles, halved)
            sizes = np.diff(np.append(starts, n))
            where = np.repeat(np.arange(len(segment)), sizes)
            without = (sums[where] - shingles)[sizes[where] > 1]
            found += [mix(sums + segment * _STEPS[1] + tags[1]), mix(without + segment[where][sizes[where] > 1] * _STEPS[1] + tags[1])]
            if int((sizes > 1).sum()) <= different // 2 or halved <= different // 2:
                found.append(mix(shingles + tags[2]))
        out.append((band & 1, max(agreeing, 1), (np.concatenate(found) & ~_U(1)) | _U(band & 1)))
    return out


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    values = np.concatenate(arrays).view(np.int64) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def document_sets(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` but its ``text``, which has no nulls, and ``n_shingles, f, need0, need1``.

    These are each set's size and identifier, and how many signatures must agree in its bands of even and of odd number.
    """
    carried = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            sets = shingle_sets(_texts(batch))
            needs: list[list[int | None]] = [[None] * len(sets), [None] * len(sets)]
            for row, shingles in enumerate(sets):
                for parity, agreeing, _ in signatures(shingles):
                    needs[parity][row] = agreeing
            made = [pa.array(map(len, sets), pa.int64()), pa.array(map(set_id, sets), pa.int64()), *(pa.array(x, pa.int32()) for x in needs)]
            yield pa.RecordBatch.from_arrays([*map(batch.column, carried), *made], names=[*carried, "n_shingles", "f", "need0", "need1"])

    kinds = [f"{c} {docs.schema[c].dataType.simpleString()}" for c in carried]
    return docs.mapInArrow(run, ", ".join([*kinds, "n_shingles long", "f long", "need0 int", "need1 int"]))


def index(docs: DataFrame) -> DataFrame:
    """``sig, f``: every signature of every set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            sets = {set_id(s): s for s in shingle_sets(_texts(batch)) if len(s) >= FIRST}
            sigs = _lists([np.concatenate([sig for _, _, sig in signatures(s)]) for s in sets.values()])
            yield pa.RecordBatch.from_arrays([pa.array(sets, pa.int64()), sigs], names=["f", "sigs"])

    return docs.select("text").mapInArrow(run, "f long, sigs array<long>").select("f", F.explode_outer("sigs").alias("sig")).where("sig is not null")


def shared(rows: DataFrame, most_held: int = 1 << 16) -> DataFrame:
    """``f, sig, cost`` of the signatures that several sets hold; the cost is how many sets, or ``HOT``.

    Rows are sorted within partitions and read in one pass that holds back the last signature of a batch. One that has more
    than ``most_held`` sets by then is ``HOT``, so that memory stays bounded however many sets hold it.
    """

    def costs(sig: np.ndarray, f: np.ndarray, hot: int | None) -> pa.RecordBatch:
        starts = np.concatenate(([0], np.flatnonzero(sig[1:] != sig[:-1]) + 1))
        sizes = np.diff(np.append(starts, len(sig)))
        cost = np.repeat(sizes, sizes).astype(np.int32)
        if hot is not None:
            cost[sig == hot] = HOT
        many = cost > 1
        return pa.RecordBatch.from_arrays([pa.array(f[many]), pa.array(sig[many]), pa.array(cost[many])], names=["f", "sig", "cost"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sig = f = np.zeros(0, np.int64)  # held back
        last: tuple[int, int] | None = None  # the last row read
        hot: int | None = None
        for batch in batches:
            new_sig, new_f = (batch.column(c).to_numpy() for c in ("sig", "f"))
            if not len(new_sig):
                continue
            fresh = np.concatenate(([last != (new_sig[0], new_f[0])], (new_sig[1:] != new_sig[:-1]) | (new_f[1:] != new_f[:-1])))
            last = int(new_sig[-1]), int(new_f[-1])
            sig, f = np.concatenate((sig, new_sig[fresh])), np.concatenate((f, new_f[fresh]))
            if not len(sig):
                continue
            end, open_run = int(np.searchsorted(sig, sig[-1])), int(sig[-1])
            before = hot
            if open_run == hot or len(sig) - end > most_held:
                hot = open_run
                yield costs(sig[end:], f[end:], hot)
                keep = len(sig)
            else:
                keep = end
            if end:
                yield costs(sig[:end], f[:end], before)
            sig, f = sig[keep:], f[keep:]
        if len(sig):
            yield costs(sig, f, None)

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "sig").sortWithinPartitions("sig", "f").mapInArrow(run, "f long, sig long, cost int")


def chosen(found: DataFrame, own: DataFrame) -> DataFrame:
    """``sig, f``: the signatures that sets index, the rarest that they cannot do without."""
    parity = F.col("sig").bitwiseAND(1).alias("parity")
    held = found.groupBy("f", parity).agg(F.sort_array(F.collect_list(F.struct("cost", "sig"))).alias("sigs"))
    sizes = own.where(F.col("n_shingles") >= FIRST).select("f", "need0", "need1").distinct()
    need = F.when(F.col("parity") == 0, F.col("need0")).otherwise(F.col("need1"))
    spare = held.join(sizes, "f").withColumn("extra", F.size("sigs") - need).where("extra >= 0")
    return spare.select("f", F.explode(F.slice("sigs", F.lit(1), F.col("extra") + 1)).alias("x")).select("x.sig", "f")


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Whether the number of shingles in each of ``SKETCH_BITS`` equal parts of the universe is odd, as numbers of 64 bits."""
    part = (shingles >> _U(64 - (SKETCH_BITS - 1).bit_length())).astype(np.int64)
    return np.packbits(np.bincount(part, minlength=SKETCH_BITS).astype(np.uint8) & 1).view(np.int64)


def candidate_sets(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """``f, n, sketch, shingles`` of the sets of texts whose keys ``k1, k2`` are in ``texts``, once each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            sets = {set_id(s): s for s in shingle_sets(_texts(batch))}
            columns = [pa.array(sets, pa.int64()), pa.array(map(len, sets.values()), pa.int32()), _lists([sketch(s) for s in sets.values()]), _lists(list(sets.values()))]
            yield pa.RecordBatch.from_arrays(columns, names=["f", "n", "sketch", "shingles"])

    wanted = docs.select("text", *text_key()).join(texts, ["k1", "k2"], "left_semi")
    return wanted.select("text").mapInArrow(run, "f long, n int, sketch array<long>, shingles array<long>").dropDuplicates(["f"])


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``a, b`` of pairs of set identifiers whose sets link, by the whole sets."""

    def side(end: str) -> DataFrame:
        return sets.select(F.col("f").alias(end), F.col("shingles").alias("x" + end), F.col("n").alias("n" + end))

    met = pairs.join(side("a"), "a").join(side("b"), "b").where(100 * F.least("na", "nb") >= THRESHOLD * F.greatest("na", "nb"))
    sizes = met.select("a", "b", F.size(F.array_intersect("xa", "xb")).alias("both"), (F.col("na") + F.col("nb")).alias("sum"))
    return sizes.where(100 * F.col("both") >= THRESHOLD * (F.col("sum") - F.col("both"))).select("a", "b")


def _least_both(n: Column, m: Column | None = None) -> Column:
    """The least number of common shingles of linked sets of sizes n and m, or of the smaller one of size n and any other."""
    total = n + (n if m is None else m)
    return F.ceil(F.lit(THRESHOLD) * total / F.lit(100 + THRESHOLD))


def _band(n: Column) -> Column:
    return F.floor(F.lit(SIZE_STEPS) * F.log(n.cast("double"))).cast("int")


def meeting(members: DataFrame, sets: DataFrame) -> DataFrame:
    """``f, n, most, shared, sketch`` of the ``members`` (``f, root``): the shingles found in several roots, and the largest partner."""
    single = sets.join(members, "f").select("f", "root", "n", F.explode("shingles").alias("shingle"))
    cost = single.groupBy("shingle").agg(F.count("*").alias("cost"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
    ordered = F.sort_array(F.collect_list(F.struct("cost", "shingle"))).alias("shared")
    held = single.join(cost.select("shingle", "cost"), "shingle").groupBy("f", "n").agg(ordered)
    # Two linked sets have 3/7 of the sum of their sizes in common: so the other may be no larger than this.
    most = F.floor(F.lit(100 + THRESHOLD) * F.size("shared") / F.lit(THRESHOLD)).cast("int") - F.col("n")
    return held.withColumn("most", most).join(sets.select("f", "sketch"), "f")


def _side(held: DataFrame, found: Column, bands: Column, least: Column) -> DataFrame:
    """Sets by the shingles that they are looked up by, for each band of sizes; at least ``least`` are in common with a partner."""
    rows = held.where(found).withColumn("band", F.explode(bands)).withColumn("extra", F.size("shared") - least).where("extra >= 0")
    rows = rows.withColumn("x", F.explode(F.slice("shared", F.lit(1), (F.col("extra") + 1).cast("int"))))
    return rows.select(F.col("x.shingle").alias("shingle"), "band", *(c for c in held.columns if c != "shared"))


def smaller_side(held: DataFrame) -> DataFrame:
    """The smaller set of each pair, with its ``place`` among those of one shingle and band; the smallest identifiers, met before, come last."""
    n = F.col("n")
    rows = _side(held, F.col("most") >= n, F.array(_band(n)), _least_both(n))
    group = Window.partitionBy("shingle", "band").orderBy(F.col("f").desc())
    return rows.withColumn("place", F.row_number().over(group))


def larger_side(held: DataFrame) -> DataFrame:
    n = F.col("n")
    lowest, highest = F.ceil(F.lit(THRESHOLD) * n / F.lit(100)).cast("int"), F.least(n, F.col("most"))
    # The more shingles partners of a band have, the more are in common with each, and the fewer must be looked up.
    first = F.greatest(lowest, F.floor(F.exp(F.col("band") / F.lit(SIZE_STEPS))).cast("int"))
    return _side(held, highest >= lowest, F.sequence(_band(lowest), _band(F.greatest(highest, lowest))), _least_both(n, first))


def across(smaller: DataFrame, larger: DataFrame) -> DataFrame:
    """``a, b``: pairs of different ``root`` that may link, by their shingles and bands."""

    def side(rows: DataFrame, end: str) -> DataFrame:
        return rows.select("shingle", "band", *(F.col(x).alias(f"{x}_{end}") for x in ("f", "root", "n", "most", "sketch")))

    differ = sum((F.bit_count(F.col("sketch_a")[i].bitwiseXOR(F.col("sketch_b")[i])) for i in range(SKETCH_BITS // 64)), F.lit(0))
    sizes = (F.col("n_a") <= F.col("n_b")) & (F.col("n_b") <= F.col("most_a")) & (F.col("n_a") <= F.col("most_b"))
    alike = differ <= F.floor(F.lit(100 - THRESHOLD) * (F.col("n_a") + F.col("n_b")) / F.lit(100 + THRESHOLD))
    a, b = side(smaller, "a").alias("a"), side(larger, "b").alias("b")
    same = (F.col("a.shingle") == F.col("b.shingle")) & (F.col("a.band") == F.col("b.band"))
    met = a.join(b, same & (F.col("root_a") != F.col("root_b")) & sizes & alike)
    return met.select(F.least("f_a", "f_b").alias("a"), F.greatest("f_a", "f_b").alias("b")).distinct()


def joined_roots(members: DataFrame, roots: DataFrame, sets: DataFrame) -> DataFrame:
    """``roots`` (``id, root``) and what links among ``members`` (``f, root``) of different roots join, in rounds of pivots."""

    def rooted(rows: DataFrame) -> DataFrame:
        return rows.join(roots, rows["f"] == roots["id"], "left").withColumn("root", F.coalesce("root", "f")).drop("id")

    with Steps(members.sparkSession) as step:
        held = step(meeting(members, sets))
        ends = step(smaller_side(held))
        done, upto = 0, PIVOTS
        while not ends.where(F.col("place") > done).isEmpty():
            larger = larger_side(rooted(held))
            if done:  # groups that still have sets of several components, of which some were no pivots yet
                left = rooted(ends.where(F.col("place") > done))
                both = left.select("shingle", "band", "root").unionAll(larger.select("shingle", "band", "root"))
                several = both.groupBy("shingle", "band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
                rest = step(left.drop("root").join(several.select("shingle", "band"), ["shingle", "band"], "left_semi"))
                step.over(ends)
                ends = rest
                if ends.isEmpty():
                    break
                larger = larger.join(ends.select("shingle", "band"), ["shingle", "band"], "left_semi")
            pivots = rooted(ends.where(F.col("place").between(done + 1, upto)))
            more = step(linked(across(pivots, larger), sets))
            if not more.isEmpty():
                roots = components(roots.select(F.col("id").alias("a"), F.col("root").alias("b")).unionAll(more))
            done, upto = upto, upto * MORE
        return roots


def set_components(docs: DataFrame, own: DataFrame) -> DataFrame:
    """``id, root``: identifiers of sets that link with others, and the smallest identifier of their component.

    ``own`` are the stored ``document_sets`` of ``docs``, with the keys ``k1, k2`` of their texts.
    """
    with Steps(docs.sparkSession) as step:
        found = step(shared(index(docs)))
        rows = step(chosen(found, own))
        step.over(found)
        smallest = rows.groupBy("sig").agg(F.min("f").alias("lo"), F.max("f").alias("hi")).where("lo < hi").drop("hi")
        held = step(rows.join(smallest, "sig"))
        step.over(rows)
        names = held.select("f").distinct()
        texts = own.join(names, "f", "left_semi").groupBy("f").agg(F.min(F.struct("k1", "k2")).alias("x")).select("x.*")
        sets = step(candidate_sets(docs, texts))
        stars = held.where("lo <> f").select(F.col("lo").alias("a"), F.col("f").alias("b")).distinct()
        links = step(linked(stars, sets))
        roots = components(links)
        placed = step(held.join(roots, held["f"] == roots["id"], "left").select("sig", "f", F.coalesce("root", "f").alias("root")))
        step.over(held)
        several = placed.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("sig")
        members = step(placed.join(several, "sig", "left_semi").select("f", "root").distinct())
        return joined_roots(members, roots, sets)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id``.

    ``component_id`` is the smallest identifier that links reach, the document's own included. Null and empty texts, and
    texts without words, have an empty set and link with nothing. Texts of fewer than five words have one shingle, the
    whole sequence. Rows that repeat an identifier or a text are linked by their equal sets; a null identifier counts as
    larger than all others and stays null where it is alone. An empty table gives an empty one.
    """
    rows = only(docs, id_col, text_col)
    own = kept(document_sets(rows.select("*", *text_key())))
    roots = set_components(rows, own)
    placed = own.join(roots, own["f"] == roots["id"], "left").select("doc_id", "n_shingles", F.coalesce("root", "f").alias("root"))
    smallest = kept(placed.where("n_shingles > 0").groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("copies")).where("copies > 1"))
    joined = placed.join(smallest, "root", "left")
    found = F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "n_shingles", found.alias("component_id"))


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns but one document of each component only, that of the smallest identifier.

    Of linked rows that share this identifier the one with the smaller hash of its text stays, of repeated rows one.
    Documents without words stay. Null identifiers count as larger than all others.
    """
    rows = only(docs, id_col, text_col)
    with Steps(docs.sparkSession) as step:
        own = step(document_sets(rows.select("*", *text_key())))
        roots = set_components(rows, own)
        placed = own.where("n_shingles > 0").join(roots, own["f"] == roots["id"], "left")
        placed = step(placed.select("doc_id", "k1", "k2", F.coalesce("root", "f").alias("root")))
        groups = step(placed.groupBy("root").agg(F.min("doc_id").alias("first_id")))
        firsts = step(placed.join(groups, "root").where(F.col("doc_id").eqNullSafe(F.col("first_id"))).groupBy("root", "doc_id", "k1", "k2").agg(F.count("*").alias("copies")))
        # The rows of one component that share its smallest identifier, one row for each text of theirs.
        stay = firsts.groupBy("root").agg(F.min(F.struct("k1", "k2", "doc_id", "copies")).alias("x")).select("x.*")
        empty = own.where("n_shingles = 0").select("k1", "k2", "doc_id", F.lit(1).cast("long").alias("copies")).distinct()
        stay = kept(stay.unionByName(empty).select(*(F.col(c).alias(f"_{c}") for c in ("doc_id", "k1", "k2", "copies"))))
    k1, k2 = (F.xxhash64(F.lit(n), text_of(text_col)) for n in (1, 2))
    same = F.col(f"`{id_col}`").eqNullSafe(F.col("_doc_id")) & (k1 == F.col("_k1")) & (k2 == F.col("_k2"))
    chosen = docs.join(stay.where("_copies = 1"), same)
    repeated = stay.where("_copies > 1")
    if not repeated.isEmpty():
        chosen = chosen.unionAll(docs.join(repeated, same).dropDuplicates(["_doc_id", "_k1", "_k2"]))
    return chosen.select(*(F.col(f"`{c}`") for c in docs.columns))
