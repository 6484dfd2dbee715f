"""Canonical exact fingerprints of documents, by DataFrame functions only.

A text's canonical form is its compatibility-composed (NFKC), lower-cased form with
runs of white space folded to one space and trimmed. Its fingerprint is a wide (128
bit) xxHash. Rows meet by fingerprint, and inside equal buckets the canonical bytes are
compared: should two forms share a hash, all but the first get a suffix, so equal
fingerprints mean equal forms. Only forms whose hash several rows have are moved for that. Likeness is 1 or 0,
by the bytes of the two forms where their hashes are equal.

``edited`` needs each document's successor by id. Ids are dealt into ranges of some
hundred rows; a window finds successors inside a range, and the few last rows get the
first row of the next range, so no task sees more than a range.

Defined results for odd input: null text is the empty text; null ids come first; rows
with equal ids follow each other by length and fingerprint; a single row is its own
successor; an empty table gives no rows; extra columns are ignored, whatever their names; very long texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import discard, scratch, table

#: Rows that a range of ids holds on average, and ranges in a range of ranges.
RANGE_ROWS, RANGE_RANGES = 100, 1000


def canonical(text: Column) -> Column:
    """NFKC, lower case, white space folded. ICU's normaliser is one of Spark's own libraries."""
    composed = F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(True))
    plain = F.octet_length(text) == F.char_length(text)  # ASCII is composed already
    return F.trim(F.regexp_replace(F.lower(F.when(plain, text).otherwise(composed)), r"(?U)\s+", " "))


def wide_hash(form: Column) -> Column:
    halves = (F.xxhash64(form), F.xxhash64(F.lit("wide"), form))
    return F.concat(*(F.lpad(F.lower(F.hex(h)), 16, "0") for h in halves))


def collisions(forms: DataFrame) -> DataFrame:
    """Canonical forms that share a wide hash: hash, form, nth (from 0) in byte order.

    Map-side aggregation leaves one row per task of a group of copies, however large.
    """
    forms = forms.groupBy("hash", "form").agg(F.count("*").alias("n"))
    shared = scratch(forms.groupBy("hash").agg(F.count("*").alias("k")).where("k > 1").select("hash"), "collisions")
    if shared.isEmpty():
        return forms.select("hash", "form", F.lit(0).alias("nth")).limit(0)
    order = Window.partitionBy("hash").orderBy("form")
    return forms.join(shared, "hash", "left_semi").select("hash", "form", (F.row_number().over(order) - 1).alias("nth"))


def _ranges(docs: DataFrame) -> Column:
    """The number of a row's range of ids."""
    low, high, n = docs.agg(F.min("doc_id"), F.max("doc_id"), F.count("*")).first()
    if low is None:
        return F.lit(0).cast("long")
    wide = max(1, -(-(high - low + 1) * RANGE_ROWS // n))
    return F.coalesce(F.expr(f"doc_id div {wide}L") if wide < 1 << 62 else F.lit(0), F.lit(-(1 << 62)))


def _repeated(base: DataFrame) -> DataFrame:
    """Per range the hashes of its rows that other rows have, too."""
    met = scratch(base.groupBy("range", "hash").agg(F.count("*").alias("m")), "prints")
    several = met.groupBy("hash").agg(F.sum("m").alias("rows")).where("rows > 1").select("hash")
    out = scratch(met.join(several, "hash").groupBy("range").agg(F.collect_list("hash").alias("several")), "several")
    discard(met)
    return out


def _prints(docs: DataFrame, whole: bool = False) -> tuple[DataFrame, DataFrame]:
    """(prints, forms): doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next (with
    ``whole`` also the edited text); and hash, form of the texts whose hash several rows have."""
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    base = base.withColumn("n_chars", F.char_length("text").cast("long")).withColumn("hash", wide_hash(canonical(F.col("text"))))
    base = base.withColumn("range", _ranges(docs))

    own = Window.partitionBy("range").orderBy("doc_id", "n_chars", "hash")
    placed = base.join(_repeated(base), "range", "left").withColumns({
        "next": F.lead(F.struct("text", "hash")).over(own),
        "first": F.row_number().over(own) == 1,
    }).withColumn("last", F.col("next").isNull())

    def alike(own: Column, other: Column, hash: Column) -> Column:
        """Equal bytes, which only equal hashes make worth while to compare."""
        return F.when(F.col("hash") == hash, canonical(own) == canonical(other)).otherwise(False).cast("double")

    def finished(df: DataFrame) -> DataFrame:
        k = F.floor(F.col("n_chars") / 4).cast("int")
        edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - k), F.substring("next.text", F.lit(1), k))
        df = df.withColumn("edited", F.when(~F.col("last"), edited))
        df = df.withColumn("edited_hash", F.when(~F.col("last"), wide_hash(canonical(F.coalesce("edited", F.lit(""))))))
        return df.withColumns({
            "edited_sha256": F.sha2("edited", 256),
            "near_edited": alike(F.col("text"), F.col("edited"), F.col("edited_hash")),
            "near_next": alike(F.col("text"), F.col("next.text"), F.col("next.hash")),
        })

    edge = F.col("first") | F.col("last")
    columns = ["doc_id", "n_chars", "hash", "edited_sha256", "edited_hash", "near_edited", "near_next", *["edited"] * whole]
    kept = {"text": F.when(edge, F.col("text")), "form": F.when(F.array_contains("several", F.col("hash")), canonical(F.col("text")))}
    done = finished(placed).select(*columns, "range", "first", "last", *(c.alias(name) for name, c in kept.items()))
    done = scratch(done, "ranges")

    firsts = done.where("first").select("range", F.struct("text", "hash").alias("head"))
    ranges = firsts.select("range", F.floor(F.col("range") / RANGE_RANGES).alias("group"))
    inner = Window.partitionBy("group").orderBy("range")
    linked = ranges.withColumn("after", F.lead("range").over(inner))
    # groups of ranges are 1/100 000 of the rows, so one ordered pass links them
    across = Window.orderBy("group")
    groups = ranges.groupBy("group").agg(F.min("range").alias("head_range"))
    groups = groups.select("group", F.lead("head_range").over(across).alias("group_after"))
    start = ranges.agg(F.min("range").alias("start"))
    linked = linked.join(groups, "group").crossJoin(F.broadcast(start))  # one row
    linked = linked.select("range", F.coalesce("after", "group_after", "start").alias("after"))
    heads = firsts.withColumnRenamed("range", "after").withColumnRenamed("head", "next")
    lasts = done.where("last").select("doc_id", "n_chars", "hash", "range", "text").join(linked, "range").join(heads, "after")
    lasts = finished(lasts.withColumn("last", F.lit(False))).select(*columns)

    out = done.where("not last").select(*columns).unionByName(lasts)
    prints = out.withColumnsRenamed({"hash": "fingerprint", "edited_hash": "edited_fingerprint"})
    return prints.select(*PRINT, *["edited"] * whole), done.where("form is not null").select("hash", "form")


PRINT = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def _forms(rows: DataFrame, text: str = "text") -> DataFrame:
    form = canonical(F.coalesce(F.col(text), F.lit("")))
    return rows.select("doc_id", form.alias("form")).withColumn("hash", wide_hash(F.col("form")))


def fingerprint(docs: DataFrame) -> DataFrame:
    """The columns of ``PRINT``, before forms that share a hash are told apart."""
    return _prints(docs)[0]


def resolved(docs: DataFrame, prints: DataFrame | None = None) -> DataFrame:
    """The fingerprints of ``docs``, with suffixes where different canonical forms share a hash.

    Edited texts are compared by bytes with their own and the next text, and with all others as soon as any texts collide.
    """
    if prints is None:
        prints, forms = _prints(docs)
    else:
        forms = _forms(docs)
    found = scratch(collisions(forms.select("hash", "form")).where("nth > 0"), "forms")
    if found.isEmpty():
        return prints
    prints, _ = _prints(docs, whole=True)
    forms = _forms(docs)
    every = forms.unionByName(_forms(prints, "edited")).select("hash", "form")
    found = scratch(collisions(every).where("nth > 0"), "forms")
    suffixed = F.concat_ws("-", "hash", F.col("nth").cast("string"))  # without nth, the hash alone
    own = forms.join(found, ["hash", "form"]).select("doc_id", F.col("hash").alias("fingerprint"), suffixed.alias("own")).distinct()
    out = prints.withColumn("form", canonical(F.col("edited"))).withColumn("hash", F.col("edited_fingerprint"))
    out = out.join(found, ["hash", "form"], "left").withColumn("edited_fingerprint", suffixed).drop("hash", "form", "nth")
    out = out.join(own, ["doc_id", "fingerprint"], "left").withColumn("fingerprint", F.coalesce("own", "fingerprint"))
    return out.select(*PRINT)


def op10_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return resolved(docs)


QUERIES = {"op10_fingerprint": op10_fingerprint}
