"""Homomorphic fingerprints of documents: a multiset hash of their paragraphs.

Each paragraph (line), and each piece of it (a sentence, cut after ``PIECE`` letters), is hashed
to a vector of ``WIDTH`` components 0 or 1. A document's fingerprint is the sum of the vectors of
all its paragraphs and pieces and their number, all modulo 2 ** 16. So the order of paragraphs doesn't count, and
the fingerprint of a changed document is that of the old one plus what came and minus what went
(``combined``). Documents with the same paragraphs have equal fingerprints; others agree in all 128
components by chance only.

Likeness of two texts: with x = 2 * component - number, the squared difference of two vectors
estimates the number of unlike paragraphs and pieces, the squares of each their sizes;
1 - difference / (size + size), cut to 0..1. Equal ones have 1. It is taken from the sums
before they are reduced, so it holds for texts with any number of pieces.

All of it is Spark's own expressions. Null texts are empty and have one empty paragraph. Sums stay
below 2 ** 31 for any text a column can hold. Rows without doc_id stand in no order: the text that
would come from the next document is empty, and near_next is null. Rows that share a doc_id have the same next document,
the one of the next larger doc_id whose text is smallest; after the last comes the first, which
for a single document is itself. Equal texts of a doc_id are worked on once. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from switchboard.llm.frames import table, text_key, text_of
from switchboard.operators.ranking import row_positions
from switchboard.session import store

WIDTH = 128
PIECE = 24
LANES = WIDTH // 2  # sums of two components each
COPIES = 1 << 16  # copies of one row that are counted out at once
_MASK = 1 | 1 << 32
_HALF = (1 << 32) - 1
_MODULUS = 1 << 16


def elements(text: Column) -> Column:
    """Paragraphs and their pieces; line breaks only part them, so their order leaves no trace."""
    pieces = F.regexp_extract_all(text, F.lit(rf"[^.!?\n]{{0,{PIECE}}}[.!?]+|[^.!?\n]{{1,{PIECE}}}"), F.lit(0))
    return F.concat(F.split(text, "\n"), pieces)


def sums(rows: DataFrame, *keys: str) -> DataFrame:
    """``vector`` per key: the components' sums and the number of elements, of the column text, not reduced.

    Keys must tell rows apart. Nothing is shuffled where rows are dealt by some of the keys.
    """
    exploded = rows.select(*keys, F.explode(elements(F.col("text"))).alias("element"))
    hashed = exploded.select(*keys, F.xxhash64("element").alias("h0"), F.xxhash64("element", F.lit(1)).alias("h1"))
    lanes = [
        F.sum(F.shiftrightunsigned(F.col(f"h{k // 32}"), k % 32).bitwiseAND(F.lit(_MASK))).alias(f"s{k}")
        for k in range(LANES)
    ]
    total = hashed.groupBy(*keys).agg(*lanes, F.count(F.lit(1)).alias("n"))
    low = [F.col(f"s{k}").bitwiseAND(F.lit(_HALF)) for k in range(LANES)]
    high = [F.shiftright(f"s{k}", 32) for k in range(LANES)]
    return total.select(*keys, F.array(*low, *high, F.col("n")).alias("vector"))


def combined(a: Column, b: Column, sign: int = 1) -> Column:
    """The vector of the paragraphs of ``a`` with those of ``b``, or without them (``sign`` -1)."""
    return F.zip_with(a, b, lambda x, y: F.pmod(x + sign * y, F.lit(_MODULUS)))


def text_form(vector: Column) -> Column:
    """The vector as hexadecimal text."""
    part = lambda k: vector[k].cast("long").bitwiseAND(F.lit(_MODULUS - 1))
    groups = []
    for at in range(0, WIDTH, 4):
        packed = part(at)
        for k in range(1, 4):
            packed = packed.bitwiseOR(F.shiftleft(part(at + k), 16 * k))
        groups.append(F.lpad(F.hex(packed), 16, "0"))
    return F.concat(*groups, F.lpad(F.hex(part(WIDTH)), 4, "0"))


def short_form(vector: Column) -> Column:
    """The sums in four bytes per component."""
    return F.transform(vector, lambda x: x.cast("int"))


def _square(vector: Column) -> Column:
    """Mean square of 2 * component - number, from the sums of components and of their squares.

    In doubles: exact up to a million elements, and for any number to many digits.
    """
    components = F.slice(vector, 1, WIDTH)
    zero = F.lit(0.0)
    first = F.aggregate(components, zero, lambda a, x: a + x.cast("double"))
    second = F.aggregate(components, zero, lambda a, x: a + x.cast("double") * x.cast("double"))
    number = F.element_at(vector, -1).cast("double")
    return (4 * second - 4 * number * first) / F.lit(WIDTH) + number * number


def likeness(a: Column, b: Column) -> Column:
    """Likeness of the texts of two vectors that are not reduced."""
    both = _square(a) + _square(b)
    apart = F.zip_with(a, b, lambda x, y: x.cast("long") - y.cast("long"))
    unlike = _square(apart) / F.nullif(both, F.lit(0.0))
    return F.when(a == b, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), 1 - F.coalesce(unlike, F.lit(1.0))))


def next_documents(docs: DataFrame) -> DataFrame:
    """doc_id, next_id, and the number of letters that the longest text of doc_id takes from the next."""
    ids = docs.groupBy("doc_id").agg(F.max(F.char_length("text")).alias("n"))
    placed = row_positions(ids, [F.col("doc_id")])
    follow = placed.select(
        F.col("doc_id").alias("next_id"),
        F.when(F.col("position") == 1, F.col("position_total")).otherwise(F.col("position") - 1).alias("position"),
    )
    taken = F.floor(F.coalesce("n", F.lit(0)) / 4).cast("int")
    return placed.join(follow, "position").select("doc_id", "next_id", taken.alias("taken"))


def edited_texts(docs: DataFrame) -> DataFrame:
    """Per doc_id and different text: doc_id, key of the text, copies, text, head, next_id and next_key.

    ``head`` is what the next document lends, ``next_key`` the key of its smallest text. Both joins deal
    the texts by doc_id, so they are moved once.
    """
    follow = next_documents(docs).withColumnsRenamed({"doc_id": "own", "next_id": "doc_id"})
    lent = docs.join(follow.hint("merge"), "doc_id").groupBy("doc_id").agg(
        F.any_value("own").alias("own"), F.min_by(text_key(), "text").alias("next_key"), F.min(F.expr("left(text, taken)")).alias("head")
    )
    lent = lent.select(F.col("own").alias("doc_id"), F.col("doc_id").alias("next_id"), "next_key", "head")
    rows = docs.join(lent.hint("merge"), "doc_id").withColumn("key", text_key())
    return _told_apart(rows, "text", "head", "next_id", "next_key")


def _told_apart(rows: DataFrame, *others: str) -> DataFrame:
    """Equal texts of a doc_id as one row with their number."""
    return rows.groupBy("doc_id", "key").agg(
        F.count(F.lit(1)).alias("copies"), *[F.any_value(c).alias(c) for c in others]
    )


def _vectors(rows: DataFrame) -> DataFrame:
    """The vectors of the texts and of their edited forms; rows are dealt by doc_id or key already."""
    quarter = "char_length(text) div 4"
    edited = F.concat(F.expr(f"left(text, char_length(text) - {quarter})"), F.expr(f"left(head, {quarter})"))
    pairs = rows.withColumn("edited", edited).withColumns(
        {"n_chars": F.char_length("text").cast("long"), "edited_sha": F.unhex(F.sha2("edited", 256))}
    )
    both = F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("text")), F.struct(F.lit(1).alias("which"), F.col("edited").alias("text"))))
    keys = ["doc_id", "key", "copies", "next_id", "next_key", "n_chars", "edited_sha"]
    made = sums(pairs.select(*keys, both.alias("t")).select(*keys, "t.which", "t.text"), *keys, "which")
    own, changed = (F.max(F.when(F.col("which") == k, F.col("vector"))) for k in (0, 1))
    made = made.groupBy(*keys).agg(own.alias("vector"), changed.alias("edited_vector"))
    # Four bytes per component.
    short = [short_form(F.col(c)).alias(c) for c in ("vector", "edited_vector")]
    return made.select(*keys, *short, likeness(F.col("vector"), F.col("edited_vector")).alias("near_edited"))


def _each_copy(rows: DataFrame) -> DataFrame:
    """One row per copy; counted out in steps, so no array grows with the copies."""
    steps = F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {COPIES}"))
    rows = rows.withColumn("_step", F.explode(steps))
    rest = F.least(F.lit(COPIES), F.col("copies") - F.col("_step") * COPIES)
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), rest)))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: the fingerprints of the text and of its edited form, and their likenesses."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    nothing = {"head": F.lit(""), "next_id": F.lit(None).cast("long"), "next_key": F.lit(None).cast("binary")}
    unnumbered = _told_apart(docs.where("doc_id is null").withColumn("key", text_key()), "text").withColumns(nothing)
    numbered = edited_texts(docs.where("doc_id is not null"))
    # Written once: the next document's vector comes from the same rows.
    made = store(_vectors(numbered), "vectors")
    following = made.select(
        F.col("doc_id").alias("next_id"), F.col("key").alias("next_key"), F.col("vector").alias("next_vector")
    )
    near_next = likeness(F.col("vector"), F.col("next_vector")).alias("near_next")
    made = made.join(following, ["next_id", "next_key"]).select("*", near_next).drop("next_vector")
    alone = _vectors(unnumbered).withColumn("near_next", F.lit(None).cast("double"))
    return _each_copy(made.unionByName(alone)).select(
        "doc_id",
        "n_chars",
        F.lower(F.hex("edited_sha")).alias("edited_sha256"),
        text_form(F.col("vector")).alias("fingerprint"),
        text_form(F.col("edited_vector")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op1(spark, folder: str) -> DataFrame:
    """The registered query: all documents."""
    return fingerprints(table(spark, folder, "documents"))
