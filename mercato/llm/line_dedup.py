"""Line dedup: of all lines that (nearly) repeat each other the first one stays.

Equal lines (without the white space at their ends) are one line with a count
from the first shuffle on.  A line's shingles are the ``SHINGLE`` characters
from each of its characters on, so text without spaces is judged in whole.
They are dealt to ``BINS`` bins by their hash; the signature holds what is least
and what is greatest of each bin with the hash turned by ``ROWS`` numbers of bits,
``BANDS`` times ``ROWS`` in all.  Lines that agree in all rows of a band, which are
of different bins, share a bucket.  Lines that share one by chance are told by the
rest of their signatures, which agree in far fewer places than those of similar
lines do.

Candidates are verified by the exact Jaccard similarity of their shingles, in
two steps that together cover every pair of a bucket without listing them
all.  First each line is compared with the ``HUBS`` most frequent ones of its
bucket, pairs that others already link aside; what this links, a distributed
union-find joins.  Then the pairs of a
bucket whose lines are still in different components are looked at.  Pairs
inside a component need no comparison: they could not change it.  Both steps
verify only such pairs as two exact bounds leave possible, both from the numbers
of the lines' distinct shingles and from maps of these, first narrow ones (512
bits), then wide ones (2048 bits).

DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import SPACES, let, released, stored
from mercato.llm.components import connected_components

#: Lines with fewer characters are compared as they are only: a single edit leaves too little in common.
LEAST = 20
#: A line without any of these is structure, not content, and always stays.
CONTENT = r"[\p{L}\p{N}]"
SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 16, 5
#: Half of BANDS: a bin's least and its greatest hashes are rows of different bands.  A power of two.
BINS = 8
#: Bits that a hash is turned by from one row to the next: what rows go by first are different bits of it, and not those of the bin.
TURN = 12
#: Bits of a row in a stored signature, and those of them that a pair of lines is told apart by.
PIECE, NIBBLE = 12, 4
#: Lines of the wanted similarity agree in that share of all rows less this at least; none of some 34,000 simulated pairs that shared a bucket was below by more than 0.22.
MARGIN = 0.25
#: Groups of lines and bins that a task finds without its slower, growing map, as a power of two.
FAST = {"spark.sql.codegen.aggregate.fastHashMap.capacityBit": "18"}
MAPS, LANES, SALTS = 8, 32, 8
#: Lines of a bucket that all others are compared with at first, and lines of a bucket that are compared in one task.
HUBS, TASK = 16, 10_000
# The shingles of a line as the groups of a regular expression.
PATTERN = rf"(?s)(?=(.{{{SHINGLE}}}))"


def starts(code_points: Column) -> Column:
    """Where the shingles of a line start, in bytes of its UTF-32 form: there a place is found without walking the line."""
    return F.sequence(F.lit(1), F.greatest(F.octet_length(code_points) - (4 * SHINGLE - 1), F.lit(1)), F.lit(4))


def hash_at(code_points: Column, at: Column) -> Column:
    return F.xxhash64(F.substring(code_points, at, F.lit(4 * SHINGLE)))


def shingle_hashes(lines: DataFrame) -> DataFrame:
    """``id, h``: a row for every shingle of every ``line``."""
    points = lines.select("id", F.encode("line", "UTF-32").alias("c"))
    return points.select("id", "c", F.explode(starts(F.col("c"))).alias("at")).select("id", hash_at(F.col("c"), F.col("at")).alias("h"))


def judged_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, of, no, line, id, id2``: every line with a letter or digit, where it stands, and two hashes of it.

    A document is known by its id and its text's hash (``of``); lines are numbered from 0.
    """
    text = F.col(text_col).cast("string")
    lines = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("of"), F.posexplode(F.split(text, "\n", -1)).alias("no", "raw"))
    # trimming and the expression go through a line letter by letter: they are asked for lines that may need it only
    edges = reduce(Column.__or__, [F.startswith("raw", F.lit(c)) | F.endswith("raw", F.lit(c)) for c in SPACES])
    begins = F.ascii("line")
    plain = begins.between(ord("0"), ord("9")) | begins.between(ord("A"), ord("Z")) | begins.between(ord("a"), ord("z"))
    trimmed = lines.select("doc_id", "of", "no", F.when(edges, F.btrim("raw", F.lit(SPACES))).otherwise(F.col("raw")).alias("line")).where(plain | F.col("line").rlike(CONTENT))
    return trimmed.withColumns({"id": F.xxhash64("line"), "id2": F.xxhash64(F.lit(1), "line")})


def place() -> Column:
    """Sorts by id (none last), then text, then line number."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "of", "no")


def turned(name: str, bits: int) -> Column:
    return F.shiftleft(name, bits).bitwiseOR(F.shiftrightunsigned(name, 64 - bits)) if bits else F.col(name)


def signatures(lines: DataFrame) -> DataFrame:
    """``id, w0``... of every line long enough: of bin k word k holds the rows of its least hashes, word BINS + k those of its greatest.

    A row is ``PIECE`` bits of a hash of the one that was chosen; that of an empty bin is 0.
    """
    distinct = lines.where(F.length("line") >= LEAST).groupBy("id").agg(F.first("line").alias("line"))
    ways = shingle_hashes(distinct).select("id", F.col("h").bitwiseAND(F.lit(BINS - 1)).alias("bin"), *[turned("h", TURN * r).alias(f"h{r}") for r in range(ROWS)])
    binned = ways.groupBy("id", "bin").agg(*[F.min(f"h{r}").alias(f"low{r}") for r in range(ROWS)], *[F.max(f"h{r}").alias(f"high{r}") for r in range(ROWS)])

    def packed(end: str) -> Column:
        pieces = [F.xxhash64(f"{end}{r}").bitwiseAND(F.lit((1 << PIECE) - 1)) for r in range(ROWS)]
        return reduce(Column.bitwiseOR, [F.shiftleft(piece, PIECE * r) for r, piece in enumerate(pieces)])

    words = binned.select("id", "bin", packed("low").alias("low"), packed("high").alias("high"))
    of_bin = lambda end, k: F.coalesce(F.max(F.when(F.col("bin") == k, F.col(end))), F.lit(0).cast("long"))
    return words.groupBy("id").agg(*[of_bin(end, k).alias(f"w{BINS * e + k}") for e, end in enumerate(("low", "high")) for k in range(BINS)])


def band(b: int) -> Column:
    """The bucket of a line by band ``b``: row r is of bin b + r."""
    rows = [F.col(f"w{b // BINS * BINS + (b + r) % BINS}").bitwiseAND(F.lit(((1 << PIECE) - 1) << PIECE * r)) for r in range(ROWS)]
    return F.xxhash64(F.lit(b), reduce(Column.bitwiseOR, rows))


def narrowed() -> list[Column]:
    """``z0``...: ``NIBBLE`` bits of every row of a signature, as many words in one as their pieces have room for."""
    mask = sum(((1 << NIBBLE) - 1) << PIECE * r for r in range(ROWS))
    each = PIECE // NIBBLE
    parts = [F.shiftleft(F.col(f"w{k}").bitwiseAND(F.lit(mask)), NIBBLE * (k % each)) for k in range(2 * BINS)]
    return [reduce(Column.bitwiseOR, parts[k:k + each]).alias(f"z{k // each}") for k in range(0, 2 * BINS, each)]


def agreeing(similarity: float) -> Column:
    """Whether two signatures, ``z0_a``... and ``z0_b``..., agree in as many rows as those of similar lines do."""
    ones = F.lit(sum(1 << k for k in range(0, PIECE * ROWS, NIBBLE)))
    apart = []
    for k in range(len(narrowed())):
        other = F.col(f"z{k}_a").bitwiseXOR(F.col(f"z{k}_b"))
        any_bit = reduce(Column.bitwiseOR, [F.shiftrightunsigned(other, k) for k in range(1, NIBBLE)], other)
        apart.append(F.bit_count(any_bit.bitwiseAND(ones)))
    return reduce(Column.__add__, apart) <= F.lit(int(BANDS * ROWS * (1 - similarity + MARGIN) + 1e-9))


def shared_buckets(lines: DataFrame, similarity: float) -> DataFrame:
    """``id, buckets`` of every line that shares a bucket with one that it may be similar to.

    In a bucket of more than ``HUBS`` lines no pairs are listed, and all of its
    lines are kept.  The signatures are stored, so that the texts' shuffle is
    gone before the buckets are dealt.
    """
    signed = stored(lambda: signatures(lines), large=True, settings=FAST)
    banded = signed.select("id", F.explode(F.array(*[band(b) for b in range(BANDS)])).alias("bucket"))
    shared = stored(banded.withColumn("lines", F.count(F.lit(1)).over(Window.partitionBy("bucket"))).where(F.col("lines") > 1))
    rows = shared.where(F.col("lines") <= HUBS).select("id", "bucket").join(signed.select("id", *narrowed()), "id")
    a, b = (rows.select(*[F.col(c).alias(f"{c}_{end}") for c in rows.columns]) for end in ("a", "b"))
    pairs = a.join(b, (F.col("bucket_a") == F.col("bucket_b")) & (F.col("id_a") < F.col("id_b")) & agreeing(similarity))
    likely = pairs.select(F.col("bucket_a").alias("bucket"), F.explode(F.array("id_a", "id_b")).alias("id")).select("id", "bucket")
    kept = likely.unionByName(shared.where(F.col("lines") > HUBS).select("id", "bucket"))
    return kept.groupBy("id").agg(F.collect_set("bucket").alias("buckets"))  # at most BANDS of a line


def candidates(lines: DataFrame, similarity: float) -> DataFrame:
    """``id, id2, n, first`` of every line that occurs again or shares a bucket; for the latter also ``line, buckets``.

    Lines of the same ``id`` but another ``id2`` (at 10^12 distinct lines some
    ten thousand by chance) are different lines that can't be told apart from
    here on; they are left out, so they stay.

    The texts are shuffled twice, for their signatures and for what is kept of
    them: the first shuffle would otherwise lie there beside that of the
    buckets until the end, and no step takes as much disk as those two.
    """
    buckets = stored(lambda: shared_buckets(lines, similarity), large=True)
    distinct = (lines.groupBy("id").agg(F.first("line").alias("line"), F.count(F.lit(1)).alias("n"), F.min(place()).alias("first"), F.min("id2").alias("id2"), F.max("id2").alias("high"))
                .where(F.col("id2") == F.col("high")).drop("high"))
    return (distinct.join(buckets, "id", "left").where((F.col("n") > 1) | F.col("buckets").isNotNull())
            .select("id", "id2", "n", "first", F.when(F.col("buckets").isNotNull(), F.col("line")).alias("line"), "buckets"))


def bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(64)).cast("int"))


def with_maps(known: DataFrame) -> DataFrame:
    """``id, n, buckets`` of the lines that share a bucket, with the number of their distinct shingles (``size``) and two maps of these.

    ``wide``: of the hash h bit h / LANES of word h modulo LANES.  ``x0``...: the
    same bits, words joined that are equal modulo MAPS; narrow enough to go
    where the line's buckets go.
    """
    # every line is whole in one task, so the texts are shuffled once and neither hashes nor words
    alike = known.where(F.col("line").isNotNull()).repartition("id")
    hashes = alike.select("id", F.explode(hashed_shingles(F.col("line"))).alias("h"))
    words = hashes.groupBy("id", F.col("h").bitwiseAND(F.lit(LANES - 1)).alias("lane")).agg(
        F.count(F.lit(1)).alias("found"), F.bit_or(bit(F.shiftright("h", LANES.bit_length() - 1))).alias("word"))
    word = lambda k: F.bit_or(F.when(F.col("lane") == k, F.col("word")).otherwise(F.lit(0).cast("long")))
    maps = words.groupBy("id").agg(F.sum("found").cast("int").alias("size"), F.array(*[word(k) for k in range(LANES)]).alias("wide"))
    joined = [F.get("wide", F.lit(k)) for k in range(LANES)]
    narrow = [reduce(Column.bitwiseOR, joined[k::MAPS]).alias(f"x{k}") for k in range(MAPS)]
    return alike.select("id", "n", "buckets").join(maps.select("*", *narrow), "id")


def hashed_shingles(line: Column) -> Column:
    """The distinct shingles of a line as hashes; the line is brought into the form they are cut from once."""
    return let(F.encode(line, "UTF-32"), lambda points: F.array_distinct(F.transform(starts(points), lambda at: hash_at(points, at))))


def similar(line_a: Column, line_b: Column, similarity: float) -> Column:
    """Whether the exact Jaccard similarity of two lines' shingles suffices; both sets and their intersection are made once."""
    def enough(a: Column, b: Column) -> Column:
        return let(F.size(F.array_intersect(a, b)), lambda n: n >= F.lit(similarity) * (F.size(a) + F.size(b) - n))

    return let(hashed_shingles(line_a), lambda a: let(hashed_shingles(line_b), lambda b: enough(a, b)))


def possible(a, b, similarity: float) -> Column:
    """Whether two lines can be similar enough: a bit of one's narrow maps that the other's lack is a shingle the other lacks.

    So at most ``size`` less such bits are shared, and what is not shared is in the union.
    """
    def alone(x, y) -> Column:
        counts = [F.bit_count(x(f"x{k}").bitwiseAND(F.bitwise_not(y(f"x{k}")))) for k in range(MAPS)]
        return sum(counts[1:], counts[0])

    most = F.least(a("size") - alone(a, b), b("size") - alone(b, a))
    return most >= F.lit(similarity) * (a("size") + b("size") - most)


def possible_in_detail(similarity: float) -> Column:
    """The same for a pair of ``wide_a, size_a`` and ``wide_b, size_b``."""
    def alone(x: str, y: str) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseAND(F.bitwise_not(b)))), F.lit(0), lambda total, n: total + n)

    most = F.least(F.col("size_a") - alone("wide_a", "wide_b"), F.col("size_b") - alone("wide_b", "wide_a"))
    return let(most, lambda m: m >= F.lit(similarity) * (F.col("size_a") + F.col("size_b") - m))


def hot_buckets(mapped: DataFrame) -> DataFrame:
    """``bucket, cuts`` of the buckets with more than ``TASK`` lines, whose lines are dealt to several tasks; few by their nature."""
    counts = mapped.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("lines"))
    return stored(counts.where(F.col("lines") > TASK).select("bucket", F.ceil(F.col("lines") / TASK).cast("int").alias("cuts")))


def in_buckets(mapped: DataFrame, hot: DataFrame, *columns: str) -> DataFrame:
    """A row for each bucket of each line, with the number of parts of the bucket (``cuts``) and the line's own (``salt``)."""
    rows = mapped.select("id", *columns, F.explode("buckets").alias("bucket")).join(F.broadcast(hot), "bucket", "left")
    cuts = F.coalesce("cuts", F.lit(1))
    return rows.select("id", *columns, "bucket", cuts.alias("cuts"), F.pmod(F.xxhash64("id"), cuts).cast("int").alias("salt"))


def hub_pairs(mapped: DataFrame, similarity: float) -> DataFrame:
    """Pairs of each line with its buckets' most frequent lines that the maps don't rule out.

    A line meets the most frequent ones before it of its part of a bucket where
    that part lies; in a bucket of several parts it also meets those of all parts.
    """
    maps = [f"x{k}" for k in range(MAPS)]
    order = (F.col("n").desc(), F.xxhash64("id"), F.col("id"))
    hub = F.struct("id", "place", "size", *maps)
    hot = hot_buckets(mapped)
    rows = in_buckets(mapped, hot, "n", "size", *maps)
    part = Window.partitionBy("bucket", "salt")
    placed = rows.withColumn("place", F.row_number().over(part.orderBy(*order)))
    met = [placed.withColumn("hubs", F.collect_list(F.when(F.col("place") <= HUBS, hub)).over(part)).select("id", "place", "size", *maps, "hubs")]
    if not hot.isEmpty():
        best = (placed.where((F.col("cuts") > 1) & (F.col("place") <= HUBS)).withColumn("place", F.row_number().over(Window.partitionBy("bucket").orderBy(*order)))
                .where(F.col("place") <= HUBS).groupBy("bucket").agg(F.collect_list(hub).alias("hubs"), F.max("cuts").alias("cuts"))
                .select("bucket", "hubs", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("salt")))
        met.append(rows.where(F.col("cuts") > 1).join(best, ["bucket", "salt"]).select("id", F.lit(HUBS + 1).alias("place"), "size", *maps, "hubs"))
    # a row for each hub: what a lambda would ask of the maps is compiled so
    pairs = (reduce(DataFrame.unionByName, met).select("id", "place", "size", *maps, F.explode("hubs").alias("h"))
             .where((F.col("h.place") < F.col("place")) & (F.col("h.id") != F.col("id")) & possible(F.col, lambda c: F.col(f"h.{c}"), similarity)).select("id", F.col("h.id").alias("hub")))
    return pairs.select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()


def ends(pairs: DataFrame, of: DataFrame, *columns: str) -> DataFrame:
    """The pairs (a, b) with columns of both their lines."""
    for end in ("a", "b"):
        pairs = pairs.join(of.select(F.col("id").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in columns]), end)
    return pairs


def detailed(pairs: Callable[[], DataFrame], mapped: DataFrame, similarity: float) -> DataFrame:
    """The pairs that the wide maps leave possible."""
    found = stored(pairs)
    return ends(found, mapped, "wide", "size").where(possible_in_detail(similarity)).select("a", "b")


def verified(pairs: Callable[[], DataFrame], known: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets are similar enough.

    Pairs are narrow, and what it takes to find or to judge them is not: each
    step's pairs are stored, so that the shuffles of one step are gone before
    those of the next are written.
    """
    worth = stored(pairs)
    # the texts travel and not the sets, which are many times larger
    both = ends(worth, known.where(F.col("line").isNotNull()), "line")
    return both.where(similar(F.col("line_a"), F.col("line_b"), similarity)).select("a", "b")


def linked(pairs: Callable[[], DataFrame], known: DataFrame, similarity: float) -> DataFrame:
    """As many of the pairs (a, b) that are similar enough as join what all of them would.

    First each line is compared with the smallest of the lines it is paired
    with.  Of the other pairs those stay aside whose lines this has linked to
    one and the same line.
    """
    found = stored(pairs)
    ways = F.explode(F.array(F.struct(F.col("a").alias("id"), F.col("b").alias("to")), F.struct(F.col("b").alias("id"), F.col("a").alias("to"))))
    least = lambda links: links.select(ways.alias("x")).groupBy("x.id").agg(F.min("x.to").alias("to"))
    marked = stored(lambda: ends(found, least(found), "to").select("a", "b", ((F.col("to_a") == F.col("b")) | (F.col("to_b") == F.col("a"))).alias("begins")))
    first = stored(verified(lambda: marked.where("begins").select("a", "b"), known, similarity))
    label = least(first).select("id", F.least("id", "to").alias("label"))

    def others() -> DataFrame:
        rest = marked.where(~F.col("begins")).select("a", "b")
        for end in ("a", "b"):
            rest = rest.join(label.select(F.col("id").alias(end), F.col("label").alias(f"label_{end}")), end, "left")
        return rest.where(F.coalesce("label_a", "a") != F.coalesce("label_b", "b")).select("a", "b")

    return first.unionByName(verified(others, known, similarity))


def remaining_pairs(mapped: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """Pairs of a bucket in different components that the maps don't rule out.

    Both maps go where the lines of such buckets meet: pairs that only the
    wide ones rule out are many more than the lines.  There either side of a
    bucket of one part is the same rows, which are shuffled once.
    """
    hot = hot_buckets(mapped)
    maps = [f"x{k}" for k in range(MAPS)]
    rows = in_buckets(mapped, hot).join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    mixed = rows.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where(F.col("low") < F.col("high")).select("bucket")
    open_rows = rows.join(mixed, "bucket").join(mapped.select("id", "size", "wide", *maps), "id")
    maybe = possible(lambda c: F.col(f"{c}_a"), lambda c: F.col(f"{c}_b"), similarity)

    def meet(left: DataFrame, right: DataFrame, *on: str) -> DataFrame:
        a, b = (side.select(*[F.col(c).alias(f"{c}_{end}") for c in (*on, "id", "root", "size", "wide", *maps)]) for side, end in ((left, "a"), (right, "b")))
        # what is dear is asked of few pairs: of a conjunction Spark may compute parts that occur twice beforehand, of a case it does not
        likely = F.when(maybe, possible_in_detail(similarity)).otherwise(F.lit(False))
        keys = reduce(Column.__and__, [F.col(f"{c}_a") == F.col(f"{c}_b") for c in on])
        return a.join(b, keys & (F.col("root_a") < F.col("root_b")) & likely).select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))

    whole = open_rows.where(F.col("cuts") == 1)
    found = meet(whole, whole, "bucket")
    if not hot.isEmpty():
        parts = open_rows.where(F.col("cuts") > 1)
        found = found.unionByName(meet(parts, parts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))), "bucket", "salt"))
    return found.distinct()


def verdicts_on(lines: DataFrame, similarity: float) -> DataFrame:
    """``id, id2, stays``: the place of the one line that stays, of every line that is known to (nearly) repeat or to share a bucket."""
    known = stored(lambda: candidates(lines, similarity), large=True)
    mapped = stored(lambda: with_maps(known))
    near = stored(lambda: linked(lambda: detailed(lambda: hub_pairs(mapped, similarity), mapped, similarity), known, similarity))
    roots = stored(lambda: connected_components(near))

    def between() -> DataFrame:
        """Links of the second round, between the roots of the first: it only joins components."""
        root_of = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))
        more = verified(lambda: remaining_pairs(mapped, roots, similarity), known, similarity)
        return (more.join(root_of("a"), "a", "left").join(root_of("b"), "b", "left")
                .select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")))

    links = stored(between)
    joined = stored(lambda: connected_components(links)).select(F.col("node").alias("root"), F.col("root").alias("top"))

    def judged() -> DataFrame:
        grouped = (known.select("id", "id2", "first").join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
                   .join(joined, "root", "left").select("id", "id2", "first", F.coalesce("top", "root").alias("root")))
        firsts = grouped.groupBy("root").agg(F.min("first").alias("stays"))
        return grouped.join(firsts, "root").select("id", "id2", "stays")

    return stored(judged)


def repeated(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, of, gone``: of each document with lines to remove their numbers."""
    lines = judged_lines(docs, id_col, text_col)
    verdicts = verdicts_on(lines, similarity)
    released(docs.sparkSession)  # the texts and maps of the lines before the documents are shuffled
    # a line that a third of all documents have is spread over salts
    told = verdicts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    where = lines.drop("line").withColumn("salt", F.pmod(F.xxhash64("of", "no"), F.lit(SALTS)).cast("int"))
    gone = where.join(told, ["id", "id2", "salt"]).where(place() != F.col("stays"))
    return stored(gone.groupBy("doc_id", "of").agg(F.collect_set("no").alias("gone")))


def drop_repeated_lines(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text", counts: bool = False) -> DataFrame:
    """The documents, all columns as they are, with the text of the lines that stay; ``n_chars``, if there, follows the text.

    Of each component of (nearly) equal lines the first stays, in order of
    id, text and line number.  Lines without a letter or digit stay;
    lines of under ``LEAST`` characters go only if they repeat an earlier one
    exactly.  Null texts stay null, empty ones empty; a document all
    of whose lines go keeps an empty text.  Null ids come last.  Rows with the
    same id and text are one document here and are treated alike.  With
    ``counts`` the columns ``_n_lines`` and ``_n_removed`` are added.
    """
    found = repeated(docs, similarity, id_col, text_col).select(F.col("doc_id").alias("_gone_id"), F.col("of").alias("_gone_of"), F.col("gone").alias("_gone"))
    text = F.col(text_col).cast("string")
    keyed = docs.withColumn("_of", F.xxhash64(text))
    joined = keyed.join(found, keyed[id_col].cast("long").eqNullSafe(found["_gone_id"]) & (keyed["_of"] == found["_gone_of"]), "left")
    split = joined.withColumn("_lines", F.split(text, "\n", -1))
    stay = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone")))
    cut = F.when(F.col("_gone").isNull(), text).otherwise(F.array_join(F.transform(stay, lambda k: F.get("_lines", k)), "\n"))
    out = split.withColumn("_kept", cut)
    columns = [F.col("_kept").alias(c) if c == text_col else F.when(F.col("_gone").isNull(), F.col(c)).otherwise(F.length("_kept").cast("long")).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns]
    extra = [F.coalesce(F.size("_lines"), F.lit(0)).cast("long").alias("_n_lines"), F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("_n_removed")] if counts else []
    return out.select(*columns, *extra)
