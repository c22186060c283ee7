"""Document fingerprints as invertible Bloom lookup sketches; DataFrame functions only.

A document's paragraphs (lines, long ones cut at sentence ends) are hashed to 64-bit digests. A
sketch has three rows of cells; a digest is put into one cell of each row: the cell's count goes
up by one, its digest and check fields are XORed. Subtracting the sketches of two versions leaves
the paragraphs that differ, with count +1 or -1. A cell with one digest left (its check fits)
gives that digest, which is then taken out of its other cells, until nothing is left. The counts
of recovered digests give the likeness of the versions, without comparing texts.

If a difference is too large to peel, the sketches are built again larger and with other places:
the digests are first dealt to stripes of a few, with a sketch per stripe, and only the digests of
stripes that fail go on to the next attempt. But for one sort the work is so in proportion to the
paragraphs, however long a text is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promolens.llm.common import stored

ROWS = 3
CELLS = 12  # cells of a row
PER_STRIPE = 8  # digests of both versions that a stripe should get at most, on average
ROUNDS = 12  # peeling rounds of a stripe
ATTEMPTS = 40  # each in other cells; a stripe that fails all of them has no chance to exist

#: A line, or of a long line at least 200 characters up to the end of a sentence.
PARAGRAPH = r"[^\n]{200,}?[.!?](?=\s|$)|[^\n]+"


def digests(text: Column) -> Column:
    """Distinct 64-bit digests of the text's paragraphs, blank ones left out."""
    parts = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PARAGRAPH), F.lit(0))
    trimmed = F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: p != "")
    return F.array_distinct(F.transform(trimmed, lambda p: F.xxhash64(p)))


def _let(value: Column, body) -> Column:
    """`body(value)`, with the value computed once although lambdas in the body use it often."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit("check")).bitwiseAND(F.lit(0xFFFFFFFF))


def _xor(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, v: a.bitwiseXOR(v))


def _placed(digest: Column, sign: Column, seed: Column) -> Column:
    """A digest with its check and its cells; another seed gives other cells."""
    return F.struct(
        digest.alias("digest"),
        sign.alias("sign"),
        _check(digest).alias("check"),
        F.array(
            *(
                F.pmod(F.xxhash64(digest, F.lit(row), seed), F.lit(CELLS)).cast("int")
                for row in range(ROWS)
            )
        ).alias("at"),
    )


def _in_cell(placed: Column, cell: Column) -> Column:
    row, at = F.floor(cell / CELLS).cast("int"), F.pmod(cell, F.lit(CELLS))
    return F.filter(placed, lambda p: F.get(p.at, row) == at)


def _sum(inside: Column) -> Column:
    """The cell that holds these digests: count, XOR of digests, XOR of checks."""
    return F.struct(
        F.aggregate(inside, F.lit(0), lambda a, p: a + p.sign).alias("n"),
        _xor(F.transform(inside, lambda p: p.digest)).alias("digest"),
        _xor(F.transform(inside, lambda p: p.check)).alias("check"),
    )


def sketch(found: Column, seed: Column) -> Column:
    """The cells of these digests, row after row."""
    return _let(
        F.transform(found, lambda d: _placed(d, F.lit(1), seed)),
        lambda placed: F.transform(
            F.sequence(F.lit(0), F.lit(ROWS * CELLS - 1)), lambda i: _sum(_in_cell(placed, i))
        ),
    )


def _minus(a: Column, b: Column) -> Column:
    return F.struct(
        (a.n - b.n).alias("n"),
        a.digest.bitwiseXOR(b.digest).alias("digest"),
        a.check.bitwiseXOR(b.check).alias("check"),
    )


def subtract(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, _minus)


def peel(difference: Column, seed: Column) -> Column:
    """ok, and how many digests only the left and only the right version has."""

    def step(state: Column, _: Column) -> Column:
        pure = F.filter(
            state.cells, lambda c: (F.abs(c.n) == 1) & (_check(c.digest) == c.check)
        )
        keys = F.transform(
            F.array_distinct(pure), lambda c: _placed(c.digest, c.n, seed)
        )
        taken = _let(
            keys,
            lambda k: F.struct(
                F.transform(
                    state.cells,
                    lambda c, i: _let(
                        _in_cell(k, i),
                        lambda inside: F.when(F.size(inside) == 0, c).otherwise(
                            _minus(c, _sum(inside))
                        ),
                    ),
                ).alias("cells"),
                (state.left + F.size(F.filter(k, lambda x: x.sign == 1))).alias("left"),
                (state.right + F.size(F.filter(k, lambda x: x.sign == -1))).alias("right"),
                (F.size(k) == 0).alias("done"),
            ),
        )
        return F.when(state.done, state).otherwise(taken)

    start = F.struct(
        difference.alias("cells"),
        F.lit(0).alias("left"),
        F.lit(0).alias("right"),
        F.lit(False).alias("done"),
    )
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)),
        start,
        step,
        lambda end: F.struct(
            F.forall(end.cells, lambda c: (c.n == 0) & (c.digest == 0)).alias("ok"),
            end.left.alias("left"),
            end.right.alias("right"),
        ),
    )


def _first_of(dealt: Column, stripe: Column) -> Column:
    """How many of the sorted `dealt` lie in stripes below this one, by bisection."""
    start = F.struct(F.lit(0).alias("low"), F.size(dealt).alias("high"))

    def step(state: Column, _: Column) -> Column:
        middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
        below = F.get(dealt, middle)["stripe"] < stripe
        return F.when(state["low"] >= state["high"], state).otherwise(
            F.struct(
                F.when(below, middle + 1).otherwise(state["low"]).alias("low"),
                F.when(below, state["high"]).otherwise(middle).alias("high"),
            )
        )

    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(dealt) + F.lit(2))).cast("int"))
    return F.aggregate(steps, start, step, lambda s: s["low"])


def _signed(found: Column, sign: int) -> Column:
    return F.transform(found, lambda d: F.struct(d.alias("d"), F.lit(sign).alias("sign")))


def _attempt(pending: Column, stripes: Column, seed: Column) -> Column:
    """Peel `pending` (d, sign) stripe by stripe: for each stripe ok, left, right and its digests.

    The digests are sorted by stripe once and a stripe is a slice of them, so the work is that of
    the sort, not stripes times digests.
    """
    dealt = F.sort_array(
        F.transform(
            pending,
            lambda x: F.struct(
                F.pmod(F.xxhash64(x["d"], seed, F.lit("stripe")), stripes).alias("stripe"),
                x["d"].alias("d"),
                x["sign"].alias("sign"),
            ),
        )
    )

    def of(inside: Column, sign: int) -> Column:
        return F.transform(F.filter(inside, lambda x: x["sign"] == sign), lambda x: x["d"])

    def peeled(inside: Column) -> Column:
        difference = subtract(sketch(of(inside, 1), seed), sketch(of(inside, -1), seed))
        return _let(
            peel(difference, seed),
            lambda p: F.struct(
                p["ok"].alias("ok"),
                p["left"].alias("left"),
                p["right"].alias("right"),
                F.transform(
                    F.filter(inside, lambda x: ~p["ok"]),
                    lambda x: F.struct(x["d"].alias("d"), x["sign"].alias("sign")),
                ).alias("again"),
            ),
        )

    def of_stripes(sorted_: Column) -> Column:
        return _let(
            F.transform(F.sequence(F.lit(0), stripes), lambda i: _first_of(sorted_, i)),
            lambda firsts: F.transform(
                F.sequence(F.lit(0), stripes - 1),
                lambda i: _let(
                    F.slice(
                        sorted_, F.get(firsts, i) + 1, F.get(firsts, i + 1) - F.get(firsts, i)
                    ),
                    peeled,
                ),
            ),
        )

    return _let(dealt, of_stripes)


def likeness(a: Column, b: Column) -> Column:
    """Shared paragraphs over all paragraphs of two versions, 0 to 1, by peeling the difference
    of their sketches; two versions without paragraphs are alike.

    First the sketches that serve as fingerprints are compared. The digests of stripes that did not
    peel go into more stripes and other cells, until all are peeled; each attempt has only what the
    one before left over.
    """

    def attempt(state: Column, k: Column) -> Column:
        size = F.size(state["pending"])
        more = F.greatest(F.lit(2), F.ceil(size / PER_STRIPE).cast("int"))
        stripes = F.when(k == 0, F.lit(1)).otherwise(more)
        found = _let(stripes, lambda s: _attempt(state["pending"], s, k + 1))

        def total(stripes: Column, side: str) -> Column:
            counts = F.transform(stripes, lambda p: F.when(p["ok"], p[side]).otherwise(F.lit(0)))
            return F.aggregate(counts, state[side], lambda t, n: t + n)

        after = _let(
            found,
            lambda stripes: F.struct(
                F.flatten(F.transform(stripes, lambda p: p["again"])).alias("pending"),
                total(stripes, "left").alias("left"),
                total(stripes, "right").alias("right"),
            ),
        )
        return F.when(size == 0, state).otherwise(after)

    start = F.struct(
        F.concat(_signed(a, 1), _signed(b, -1)).alias("pending"),
        F.lit(0).alias("left"),
        F.lit(0).alias("right"),
    )
    found = F.aggregate(F.sequence(F.lit(0), F.lit(ATTEMPTS)), start, attempt)
    # A stripe of few digests fails an attempt with a small probability, independent of the others.
    unfinished = F.raise_error(F.lit("paragraph digests that cannot be peeled")).cast("double")
    return _let(
        found,
        lambda f: F.when(F.size(f["pending"]) > 0, unfinished)
        .when(F.size(a) + f["right"] == 0, F.lit(1.0))
        .otherwise((F.size(a) - f["left"]) / (F.size(a) + f["right"])),
    )


def fingerprint(found: Column) -> Column:
    """The sketch of one stripe as a string: count, digest and check of each cell."""
    return F.array_join(
        F.transform(
            sketch(found, F.lit(1)),
            lambda c: F.concat_ws(":", c.n.cast("string"), F.hex(c.digest), F.hex(c.check)),
        ),
        ",",
    )


KEY = ("named", "id")  # doc_id as two columns without NULL, so that equality joins on it


def keyed(docs: DataFrame, *columns: Column) -> DataFrame:
    """`columns` next to doc_id's key; a NULL doc_id is the smallest."""
    named = F.col("doc_id").isNotNull().alias("named")
    return docs.select(named, F.coalesce("doc_id", F.lit(0)).alias("id"), *columns)


def successors(docs: DataFrame) -> DataFrame:
    """The key of each doc_id, that of the next larger doc_id (after the last one the first), and
    half the length of the document's (longest) text.

    Ids are sorted in ranges and stored with their range; a range's last id is followed by the
    first id of the next range, and the ranges are as few as tasks.
    """
    ids = keyed(docs, F.floor(F.length("text") / 2).cast("int").alias("half"))
    ids = ids.groupBy(*KEY).agg(F.coalesce(F.max("half"), F.lit(0)).alias("half"))
    ranged = stored(
        ids.repartitionByRange(*KEY).withColumn("part", F.spark_partition_id())
    ).withColumn("key", F.struct(*KEY))
    parts = ranged.groupBy("part").agg(F.min("key").alias("first"))
    order = Window.orderBy("part")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = F.coalesce(F.lead("first").over(order), F.first("first").over(whole))
    within = F.lead("key").over(Window.partitionBy("part").orderBy("key"))
    return (
        ranged.withColumn("next", within)
        .join(parts.select("part", after.alias("after")), "part")
        .select(*KEY, F.coalesce("next", "after").alias("next"), "half")
    )


def with_successors(docs: DataFrame) -> DataFrame:
    """Each document with the head of the next one's text and that one's digests.

    The texts are dealt once by doc_id; of the next text only the digests and as many characters
    as can replace half of a text travel on. Of several rows with the next doc_id the least text
    is taken.
    """
    # Both uses need the same columns, so that they share the shuffle.
    texts = keyed(docs, F.coalesce("text", F.lit("")).alias("text")).repartition(*KEY)
    following = texts.groupBy(*KEY).agg(F.min("text").alias("text"))
    pairs = successors(docs).select(
        *(F.col(k).alias(f"before_{k}") for k in KEY),
        *(F.col("next")[k].alias(k) for k in KEY),
        "half",
    )
    heads = following.join(pairs, [*KEY]).select(
        *(F.col(f"before_{k}").alias(k) for k in KEY),
        F.left("text", F.col("half")).alias("head"),
        digests(F.col("text")).alias("next_digests"),
    )
    return texts.join(heads, [*KEY]).withColumn("doc_id", F.when(F.col("named"), F.col("id")))


def compared(docs: DataFrame) -> DataFrame:
    """Fingerprints of each document and of its edited text, and how near versions are.

    The edited text has the last half of its characters replaced by as many of the next
    document's first ones. A NULL text counts as empty. Repeated rows are compared each. Other
    columns are ignored. The result has doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.
    """
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.left("text", F.col("n_chars").cast("int") - half), F.left("head", half))
    versions = (
        with_successors(docs)
        .withColumn("n_chars", F.length("text").cast("long"))
        .withColumn("edited", edited)
        .select(
            "doc_id",
            "n_chars",
            F.sha2("edited", 256).alias("edited_sha256"),
            digests(F.col("text")).alias("own"),
            digests(F.col("edited")).alias("other"),
            "next_digests",
        )
    )
    own, other = F.col("own"), F.col("other")
    return versions.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint(own).alias("fingerprint"),
        fingerprint(other).alias("edited_fingerprint"),
        likeness(own, other).alias("near_edited"),
        likeness(own, F.col("next_digests")).alias("near_next"),
    )
