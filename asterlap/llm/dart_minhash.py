"""Near duplicates by DartMinHash signatures of word shingles and banded joins.

A text is a weighted set: its shingles of five words and how often it has each. Darts are thrown at the plane of weight
and rank of every shingle: each unit square holds a Poisson number of darts whose places follow from hashes of shingle
and square alone. The darts within a shingle's weight, up to a rank that grows until every coordinate has one, fall on
random coordinates; the earliest dart of each is the signature, whose coordinates agree with the weighted Jaccard
similarity as their chance. The work is linear in shingles and darts, however many coordinates there are.

Bands of the signature are joined. Copies of one text are one class from the start. In each bucket of a band, texts are
held against the bucket's first; candidates whose signatures agree too little to be near (over five standard deviations)
go, the others are compared exactly on their shingles. Linked texts become components; then only texts of *different*
components within a bucket are still open. Texts with too many shingles that no other text has cannot be near any; that
bound is exact, linear, and settles most of a large group's distant copies. The others are held against another text of
the bucket, again and again while that joins components and leaves many open, the more of them the fewer texts are left,
and at last against all that remain open: so no link that the bands found is lost, and a large group of near copies
doesn't become all its pairs. In large buckets that last comparison is done block against block: only pairs whose
signatures agree, and whose shingles, counted by residue classes of their hashes, leave a similarity of 0.8 possible (an
exact bound), become rows.

Defined cases: a text of one to four words is one shingle; texts without words (null, empty) are near nothing and a
class each; copies, repeated rows and null IDs included, share a class; class_id is the least ID of the class, null if
it has none; an empty table gives no rows; columns other than doc_id and text are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_batches, document_key, free_name, join_counted, stored, stored_and_measured, table, text_of
from .components import components
from .word_hashes import WordHashes, batch_windows

SHINGLE = 5
SIMILARITY = 0.8
#: At similarity 0.8, a pair misses all bands with a chance of (1 - 0.8**4)**28, under one in a million.
BANDS, BAND_ROWS = 28, 4
SIGNATURE = BANDS * BAND_ROWS
#: Agreement of signatures below which a pair is not compared: 5.3 standard deviations under 0.8.
LEAST_AGREEMENT = 0.6
#: Open pairs (counted in every bucket) per text that shares buckets, up to which all that are open are compared. A pair
#: that is open meets in several bands, so these are some 50 different pairs, which cost about what the signature cost.
OPEN_PER_TEXT = 400
#: Open pairs (counted in every bucket) up to which all that are open are compared, however few texts there are.
FEW_OPEN = 50_000
#: Texts of a bucket up to which its open pairs become rows, and texts of a block in larger ones.
SMALL_BUCKET, BLOCK = 32, 1024
#: Classes of shingle hashes, by whose counts a pair's common shingles are bounded.
CLASSES = 256
#: Firsts of buckets that a text is held against in a turn: at least so many, and up to one for every band as long as the
#: turn has no more than PAIRS_PER_TURN pairs.
LEADERS = 3
PAIRS_PER_TURN = 50_000
#: Pairs that a task compares at least, if there are so many.
PAIRS_PER_TASK = 2000
#: Rows of a file in the tables of a turn, which get smaller from turn to turn.
ROWS_PER_FILE = 200_000
#: Keys of buckets, texts or pairs, 8 to 24 bytes each, are broadcast up to this number of rows and shuffled beyond it.
BROADCAST_ROWS = 1_000_000
#: Odd numbers that tell the uses of a hash apart.
STEPS = tuple(map(np.uint64, (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7, 0xA24BAED4963EE407, 0x9FB21C651E98DF25)))

#: Cumulative chances of 0, 1, 2, ... darts in a unit square (Poisson with mean 1).
_POISSON = np.cumsum([np.exp(-1.0) / np.prod(np.arange(1, k + 1, dtype=float)) for k in range(18)])


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers from 0 to 1."""
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def darts(ids: np.ndarray, weights: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Element, hash and rank of the darts inside the weights of the elements ``ids``, low <= rank < high by element.

    Squares are unit steps of weight times unit steps of rank; an element's squares within its weight and below its
    highest rank are laid out one after another, for all elements at once."""
    first, strips = np.floor(low).astype(np.int64), np.ceil(high).astype(np.int64)
    strips -= first
    columns = np.ceil(weights).astype(np.int64)
    squares = strips * columns
    element = np.repeat(np.arange(len(ids)), squares)
    nth = np.arange(len(element)) - np.repeat(np.cumsum(squares) - squares, squares)
    column, strip = nth // strips[element], first[element] + nth % strips[element]
    square = mix(mix(ids[element] + STEPS[0] * (column.astype(np.uint64) + np.uint64(1))) ^ (STEPS[1] * (strip.astype(np.uint64) + np.uint64(1))))
    number = np.searchsorted(_POISSON, unit(square))
    of = np.repeat(np.arange(len(square)), number)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(number) - number, number)
    dart = mix(square[of] + STEPS[2] * (nth.astype(np.uint64) + np.uint64(1)))
    rank, element = strip[of] + unit(dart), element[of]
    inside = (rank >= low[element]) & (rank < high[element]) & (column[of] + unit(mix(dart ^ STEPS[3])) <= weights[element])
    return element[inside], dart[inside], rank[inside]


def signatures_of(sets: list[tuple[np.ndarray, np.ndarray]], size: int = SIGNATURE) -> np.ndarray:
    """For each weighted set (distinct 64-bit ids, weights; not empty) and each coordinate, 16 bits of the earliest dart
    on it. At first, ranks go as far as gives each coordinate a dart in most sets; for the others, further."""
    lengths = np.array([len(i) for i, _ in sets], np.int64)
    ids = np.concatenate([i for i, _ in sets]).astype(np.uint64)
    weights = np.concatenate([w for _, w in sets]).astype(np.float64)
    owner = np.repeat(np.arange(len(sets)), lengths)
    low = np.zeros(len(sets))
    high = (size * np.log(size) + 2 * size) / np.bincount(owner, weights, len(sets))
    least, out = np.full((len(sets), size), np.inf), np.zeros((len(sets), size), np.uint16)
    todo = np.ones(len(sets), bool)
    while todo.any():
        use = todo[owner]
        whose = owner[use]
        element, dart, rank = darts(ids[use], weights[use], low[whose], high[whose])
        place = whose[element] * size + (mix(dart ^ STEPS[4]) % np.uint64(size)).astype(np.int64)
        new = ~np.isfinite(least.ravel()[place])
        place, dart, rank = place[new], dart[new], rank[new]
        order = np.argsort(rank)[::-1]  # of several darts on one coordinate, the last written is the earliest
        least.ravel()[place[order]] = rank[order]
        out.ravel()[place[order]] = (mix(dart[order]) >> np.uint64(48)).astype(np.uint16)
        todo = ~np.isfinite(least).all(axis=1)
        low, high = np.where(todo, high, low), np.where(todo, 1.5 * high, high)
    return out


def shingle_sets(texts: list[bytes], hashes: WordHashes, size: int = SHINGLE) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct shingle hashes, in order, and how often each text has them; a text of fewer words is one shingle."""
    words, firsts, starts, pairs = batch_windows(texts, size, hashes)
    keys = mix(pairs[:, 0] ^ mix(pairs[:, 1]))
    cuts = np.searchsorted(starts, [*firsts.tolist(), sum(map(len, words))])
    out = []
    for i, ws in enumerate(words):
        own = keys[cuts[i] : cuts[i + 1]]
        if ws and len(ws) < size:
            own = np.array([xxhash.xxh3_64_intdigest(b" ".join(ws), seed=len(ws))], np.uint64)
        out.append(np.unique(own, return_counts=True))
    return out


def expanded(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The multiset as a set: one hash for each time an element occurs, in order."""
    again = np.repeat(ids, counts)
    nth = np.arange(len(again)) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.sort(np.where(nth == 0, again, mix(again + STEPS[0] * nth.astype(np.uint64))))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two expanded multisets."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def tally(ids: np.ndarray) -> np.ndarray:
    """How many of the hashes are in each class, up to 65535."""
    return np.minimum(np.bincount((ids % np.uint64(CLASSES)).astype(np.int64), minlength=CLASSES), 65535).astype(np.uint16)


def may_be_near(one: np.ndarray, others: np.ndarray, similarity: float = SIMILARITY) -> np.ndarray:
    """Whether the tally ``one`` and each of ``others`` leave the similarity possible: no more shingles of a class are
    common than the text with fewer of them has. Classes that are full say nothing."""
    common = np.minimum(others, one).sum(axis=1, dtype=np.int64)
    union = others.sum(axis=1, dtype=np.int64) + one.sum(dtype=np.int64) - common
    return (common >= similarity * union - 1e-9) | (others == 65535).any(axis=1) | (one == 65535).any()


def signatures(docs: DataFrame) -> DataFrame:
    """k_id, k_text, doc_id, t1, t2 (hashes of the words) and the signature, four coordinates to a number, of every row.
    The last three are null for a text without words."""
    arrow_batches(docs.sparkSession)
    rows = docs.select(*document_key(docs), docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).cast("binary").alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            texts = b.column(3).to_pylist()
            sets = shingle_sets(texts, hashes)
            some = [i for i, s in enumerate(sets) if len(s[0])]
            t1, t2, sig = ([None] * len(texts) for _ in range(3))
            for i, own in zip(some, signatures_of([sets[i] for i in some]) if some else ()):
                t1[i], t2[i] = np.frombuffer(xxhash.xxh3_128_digest(b" ".join(texts[i].split())), np.int64).tolist()
                sig[i] = own.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array(t1, pa.int64()), pa.array(t2, pa.int64()), pa.array(sig, pa.list_(pa.int64()))],
                names=["k_id", "k_text", "doc_id", "t1", "t2", "sig"],
            )

    return rows.mapInArrow(sign, "k_id long, k_text long, doc_id long, t1 long, t2 long, sig array<long>")


def _for_python(rows: DataFrame, number: int) -> DataFrame:
    """``rows``, ``number`` at most, in as many tasks as that is worth: each starts Python once."""
    return rows.coalesce(max(1, -(-number // PAIRS_PER_TASK)))


def agreeing(pairs: DataFrame, units: DataFrame, number: int) -> DataFrame:
    """The pairs (a, b) of texts, ``number`` at most, whose signatures agree in at least LEAST_AGREEMENT of their
    coordinates."""
    side = lambda name: units.select(F.col("u").alias(name), F.col("sig").alias(f"sig_{name}"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (batch.column(c).flatten().to_numpy().view(np.uint16).reshape(-1, SIGNATURE) for c in (2, 3))
            enough = (x == y).mean(axis=1) >= LEAST_AGREEMENT
            yield batch.select([0, 1]).filter(pa.array(enough))

    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sig_a", "sig_b")
    return _for_python(both, number).mapInArrow(compare, "a long, b long")


def shingles_of(docs: DataFrame, units: DataFrame) -> DataFrame:
    """(u, ids, tally): the expanded shingles of the texts ``units`` (u, k_id, k_text), and how many are in each class."""
    key_id, key_text = document_key(docs)
    units = units.select("u", "k_id", "k_text")
    if units.count() <= BROADCAST_ROWS:
        units = F.broadcast(units)
    rows = docs.select(key_id, key_text, text_of(docs).cast("binary").alias("text")).join(units, ["k_id", "k_text"]).select("u", "text")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            sets = [expanded(*s) for s in shingle_sets(b.column(1).to_pylist(), hashes)]
            binary = lambda arrays: pa.array([x.tobytes() for x in arrays], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), binary(sets), binary(map(tally, sets))], names=["u", "ids", "tally"])

    # Rows with the same ID and text have the same shingles: one of them is enough.
    return rows.mapInArrow(make, "u long, ids binary, tally binary").groupBy("u").agg(F.min("ids").alias("ids"), F.min("tally").alias("tally"))


def near(pairs: DataFrame, shingles: DataFrame, number: int, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs, ``number`` at most, whose exact similarity is at least ``similarity``."""
    side = lambda name: shingles.select(F.col("u").alias(name), F.col("ids").alias(f"ids_{name}"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = ([np.frombuffer(x, np.uint64) for x in batch.column(c).to_pylist()] for c in (2, 3))
            yield batch.select([0, 1]).filter(pa.array([jaccard(x, y) >= similarity for x, y in zip(*sets)], pa.bool_()))

    # Few pairs go to the shingles, instead of all shingles to the pairs.
    few = F.broadcast if number <= BROADCAST_ROWS else (lambda df: df)
    right = side("b").join(few(pairs.select("b")), "b", "left_semi")
    both = side("a").join(few(pairs), "a").join(right, "b").select("a", "b", "ids_a", "ids_b")
    return _for_python(both, number).mapInArrow(compare, "a long, b long")


def _pair(one: str, other: str) -> list[Column]:
    return [F.least(one, other).alias("a"), F.greatest(one, other).alias("b")]


def _against_first(rows: DataFrame, leaders: int) -> DataFrame:
    """Pairs of each text with the firsts of its buckets, where they are of two components: with the ``leaders`` of them
    that it shares most buckets with."""
    met = rows.filter("comp <> f_comp")
    if leaders >= BANDS:
        return met.select(*_pair("u", "f")).distinct()
    shared = met.groupBy("u", "f").agg(F.count(F.lit(1)).alias("n"))
    most = F.slice(F.sort_array(F.collect_list(F.struct("n", "f")), asc=False), 1, leaders)  # of one for each band at most
    best = shared.groupBy("u").agg(most.alias("most")).select("u", F.explode("most.f").alias("f"))
    return best.select(*_pair("u", "f")).distinct()


def _all_open(rows: DataFrame, units: DataFrame, shingles: DataFrame) -> DataFrame:
    """All pairs of texts of two components that share a bucket; of large buckets, those that can be near."""
    large = _in_blocks(rows.filter(F.col("many") > SMALL_BUCKET), units, shingles)
    return _in_small_buckets(rows.filter(F.col("many") <= SMALL_BUCKET)).union(large).distinct()


def _in_small_buckets(rows: DataFrame) -> DataFrame:
    other = rows.select("band", F.col("u").alias("v"), F.col("comp").alias("v_comp"))
    met = rows.join(other, "band").filter("u < v and comp <> v_comp")
    return met.select(F.col("u").alias("a"), F.col("v").alias("b"))


def _in_blocks(rows: DataFrame, units: DataFrame, shingles: DataFrame) -> DataFrame:
    """Pairs of two components in a bucket whose signatures agree enough and whose tallies allow it, each in the first of
    the bands that it shares. A bucket's texts are dealt to blocks, and every two blocks meet in a task."""
    known = units.select("u", "sig").join(shingles.select("u", "tally"), "u")
    blocks = F.ceil(F.col("many") / BLOCK)
    dealt = rows.select("u", "band", "place", "comp", F.pmod(F.xxhash64("u"), blocks).alias("block"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    met = dealt.join(known, "u").select("*", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))

    def compare(table: pa.Table) -> pa.Table:
        u, comp, block = (table.column(c).to_numpy() for c in ("u", "comp", "block"))
        place = table.column("place")[0].as_py()
        sigs = np.array(table.column("sig").to_pylist(), np.int64).view(np.uint16).reshape(-1, SIGNATURE)
        tallies = np.frombuffer(b"".join(table.column("tally").to_pylist()), np.uint16).reshape(-1, CLASSES)
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
        a, b = [], []
        for k, i in enumerate(left):
            to = right[k + 1 :] if low == high else right
            to = to[comp[to] != comp[i]]
            equal = sigs[to] == sigs[i]
            first = equal.reshape(-1, BANDS, BAND_ROWS).all(axis=2).argmax(axis=1) == place
            to = to[first & (equal.mean(axis=1) >= LEAST_AGREEMENT)]
            to = to[may_be_near(tallies[i], tallies[to])]
            a.append(np.minimum(u[i], u[to]))
            b.append(np.maximum(u[i], u[to]))
        empty = np.zeros(0, np.int64)
        return pa.table({"a": np.concatenate([empty, *a]), "b": np.concatenate([empty, *b])})

    return met.groupBy("band", "low", "high").applyInArrow(compare, "a long, b long")


def unshared(shingles: DataFrame) -> DataFrame:
    """(u, size, common): how many shingles a text has, and how many of them any other text has too."""

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [np.frombuffer(x, np.int64) for x in b.column(1).to_pylist()]
            owners = np.repeat(b.column(0).to_numpy(), [len(x) for x in sets])
            yield pa.RecordBatch.from_arrays([pa.array(owners), pa.array(np.concatenate(sets))], names=["u", "id"])

    single = shingles.mapInArrow(flat, "u long, id long").groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.min("u").alias("u")).filter("n = 1")
    alone = single.groupBy("u").agg(F.count(F.lit(1)).alias("alone"))
    size = F.octet_length("ids") / 8
    return shingles.select("u", size.alias("size")).join(alone, "u", "left").select("u", "size", (F.col("size") - F.coalesce("alone", F.lit(0))).alias("common"))


def _files(rows: int) -> int:
    return max(1, -(-rows // ROWS_PER_FILE))


def _still_open(rows: DataFrame, turn: int, number: int) -> tuple[DataFrame, int, int, float]:
    """The rows (``number`` at most) of buckets with several components, with each bucket's first text of this turn (f,
    f_comp), its smallest text's size (least) and its number of texts (many); how many texts, rows and open pairs these are."""
    # In the turn after the first, the text with the fewest shingles of its own is the likeliest to be near many.
    rank = F.col("size") - F.col("common") if turn == 1 else F.lit(0.0)
    place = F.struct(rank.alias("r"), F.xxhash64("band", "u", F.lit(turn)).alias("o"), "u", "comp")
    each = rows.groupBy("band", "comp").agg(F.count(F.lit(1)).alias("n"), F.min("size").alias("least"), F.min(place).alias("first"))
    squares = F.sum(F.col("n") * F.col("n"))
    whole = each.groupBy("band").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.min("first").alias("first"), squares.alias("own"), F.count(F.lit(1)).alias("parts"))
    pairs = (F.col("n") * F.col("n") - F.col("own")) / 2
    whole = whole.filter("parts > 1").select("band", "n", "least", F.col("first.u").alias("f"), F.col("first.comp").alias("f_comp"), pairs.alias("pairs"))
    zero = F.lit(0)
    buckets, seen = stored_and_measured(whole, "minhash-buckets", _files(number), pairs=F.coalesce(F.sum("pairs"), zero), rows=F.coalesce(F.sum("n"), zero))
    if not seen["rows"]:
        return rows, 0, 0, 0.0
    met = join_counted(rows.drop("least", "f", "f_comp", "many"), buckets.drop("pairs"), ["band"], "n", seen["rows"]).withColumnRenamed("n", "many")
    met, found = stored_and_measured(met, "minhash-open", _files(seen["rows"]), texts=F.approx_count_distinct("u"))
    return met, found["texts"], seen["rows"], float(seen["pairs"])


def _can_link(similarity: float = SIMILARITY) -> Column:
    """Whether a text can be near any of its bucket: at best it has all its common shingles in common with a text that is
    no smaller than those, or than the smallest of the bucket."""
    best = F.col("common") / (F.col("size") + F.greatest("common", "least") - F.col("common"))
    return best >= similarity - 1e-9


def _units(rows: DataFrame) -> DataFrame:
    """u, t1, t2, k_id, k_text, sig, copies: one row per distinct sequence of words."""
    known = rows.filter("sig is not null").groupBy("t1", "t2")
    found = known.agg(F.min(F.struct("k_id", "k_text")).alias("k"), F.first("sig").alias("sig"), F.count(F.lit(1)).alias("copies"))
    return stored(found.select(F.monotonically_increasing_id().alias("u"), "t1", "t2", "k.k_id", "k.k_text", "sig", "copies"), "minhash-texts")


def linked(docs: DataFrame, units: DataFrame) -> DataFrame:
    """(u, comp) of the texts that are linked to others."""
    spark = docs.sparkSession
    buckets = units.select("u", F.posexplode("sig").alias("place", "part")).select("u", "place", F.xxhash64("place", "part").alias("band"))
    shared = stored(buckets.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "minhash-shared")
    total = shared.agg(F.sum("n")).first()[0] or 0
    if shared.count() <= BROADCAST_ROWS:
        met = buckets.join(F.broadcast(shared.select("band")), "band", "left_semi")
    else:
        met = join_counted(buckets, shared, ["band"], "n", total)
    members = stored(met.select("u", "place", "band"), "minhash-members")
    paired = stored(units.select("u", "k_id", "k_text", "sig").join(members, "u", "left_semi"), "minhash-paired")
    shingles = stored(shingles_of(docs, paired), "minhash-shingles")

    # At first, every text is a component of its own, and every bucket that several share is open.
    rows = members.withColumns({"comp": F.col("u"), "size": F.lit(0.0), "common": F.lit(0.0)})
    comps, linked_texts, all_texts, turn, joined = spark.createDataFrame([], "u long, comp long"), 0, paired.count(), 0, 1
    rows, texts, total, open_pairs = _still_open(rows, 0, total)
    while total:
        last = turn > 0 and (open_pairs <= max(FEW_OPEN, OPEN_PER_TEXT * all_texts) or not joined)
        leaders = min(BANDS, max(LEADERS, PAIRS_PER_TURN // texts)) if turn else LEADERS
        pairs = _all_open(rows, paired, shingles) if last else _against_first(rows, leaders)
        pairs, seen = stored_and_measured(pairs, "minhash-pairs", None if last else _files(leaders * texts), n=F.count(F.lit(1)))
        alike, seen = stored_and_measured(agreeing(pairs, paired, seen["n"]), "minhash-compared", None, n=F.count(F.lit(1)))
        new, seen = stored_and_measured(near(alike, shingles, seen["n"]), "minhash-links", None, n=F.count(F.lit(1)))
        joined = seen["n"]
        if joined:
            linked_texts += 2 * joined
            merged = _merged(comps, new, joined) if turn else components(new, joined)
            comps = stored(merged.coalesce(_files(linked_texts)), "minhash-components")
        if last:
            break
        if not turn:
            rows = rows.drop("size", "common").join(unshared(shingles), "u")
        turn += 1
        rows = _with_components(rows.drop("comp"), comps)
        if turn == 1:
            # Many texts of large groups are too far from all others: what they have alone says so, without pairs.
            rows = _still_open(stored(rows, "minhash-rows"), turn, total)[0]
            if "least" not in rows.columns:
                break
            rows = rows.filter(_can_link())
        rows, texts, total, open_pairs = _still_open(stored(rows.coalesce(_files(total)), "minhash-rows"), turn, total)
    return comps


def _merged(comps: DataFrame, new: DataFrame, number: int) -> DataFrame:
    """The components (u, comp) with those joined that the new links (a, b) connect."""
    side = lambda name: comps.select(F.col("u").alias(name), F.col("comp").alias(f"comp_{name}"))
    between = new.join(side("a"), "a", "left").join(side("b"), "b", "left")
    between = between.select(F.coalesce("comp_a", "a").alias("a"), F.coalesce("comp_b", "b").alias("b"))
    step = components(between, number)
    moved = comps.join(step.select(F.col("u").alias("comp"), F.col("comp").alias("to")), "comp", "left")
    return moved.select("u", F.coalesce("to", "comp").alias("comp")).unionByName(step.join(comps, "u", "left_anti"))


def _with_components(rows: DataFrame, comps: DataFrame) -> DataFrame:
    return rows.join(comps, "u", "left").withColumn("comp", F.coalesce("comp", "u"))


def classes(docs: DataFrame) -> DataFrame:
    """k_id, k_text, doc_id, and of the row's class: class_id (least ID), c_id and c_text (key of the document that
    stands for it), copies (rows with the same words), texts (distinct texts) of every row."""
    rows = stored(signatures(docs), "minhash-signatures")
    units = _units(rows)
    comps = linked(docs, units)
    placed = units.select("u", "t1", "t2", "copies").join(comps, "u", "left").withColumn("comp", F.coalesce("comp", "u"))
    placed = stored(placed.drop("u"), "minhash-placed")
    known = rows.filter("sig is not null").drop("sig")
    total = placed.agg(F.sum("copies")).first()[0] or 0
    members = stored(join_counted(known, placed, ["t1", "t2"], "copies", total), "minhash-classes")
    stands = members.groupBy("comp").agg(
        F.min("doc_id").alias("class_id"), F.min(F.struct("k_id", "k_text")).alias("c"), F.count(F.lit(1)).alias("members"),
    )
    texts = placed.groupBy("comp").agg(F.count(F.lit(1)).alias("texts"))
    stands = stored(stands.join(texts, "comp").select("comp", "class_id", F.col("c.k_id").alias("c_id"), F.col("c.k_text").alias("c_text"), "members", "texts"), "minhash-stands")
    out = ["k_id", "k_text", "doc_id", "class_id", "c_id", "c_text", "copies", "texts"]
    found = join_counted(members, stands, ["comp"], "members", total).select(*out)
    alone = rows.filter("sig is null").select(
        "k_id", "k_text", "doc_id", F.col("doc_id").alias("class_id"), F.col("k_id").alias("c_id"), F.col("k_text").alias("c_text"),
        F.lit(1).cast("long").alias("copies"), F.lit(1).cast("long").alias("texts"),
    )
    return found.unionByName(alone)


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents without those that another of their class stands for. Texts without words all stay."""
    found = classes(docs)
    keep = found.filter("k_id = c_id and k_text = c_text").select(F.col("k_id").alias("c_id"), F.col("k_text").alias("c_text")).distinct()
    key_id, key_text = free_name(docs, "key_id"), free_name(docs, "key_text")
    own_id, own_text = document_key(docs)
    keyed = docs.select("*", own_id.alias(key_id), own_text.alias(key_text))
    joined = keyed.join(keep, (F.col(key_id) == keep["c_id"]) & (F.col(key_text) == keep["c_text"]), "left_semi")
    return joined.dropDuplicates([key_id, key_text]).drop(key_id, key_text)


def op4_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "copies", "texts")
