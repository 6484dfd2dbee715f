"""Line formats as DataFrames: id lists, GFF3, VCF, FASTA, PAF, SAM, JSON reports, position tracks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.operators.contracts import Check
from tessera.operators.dedupe import accept_first
from tessera.operators.intervals import gap_clusters
from tessera.storage import discard, scratch


def lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, n, value): lines with a number that rises in file order (not dense)."""
    return spark.read.text(path).select(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("n"), "value")


def id_list(text: DataFrame, chunk: int | None = None) -> DataFrame:
    """Ids of (n, value) lines: comma or blank separated, ``#`` comments, positive integers, first occurrence kept.

    Columns: line, position, raw_value, id, accepted, accepted_index, duplicate_of_index and, with
    ``chunk``, the number of the accepted id's chunk. Other tokens are an error.
    """
    bare = text.select(F.col("n").alias("line"), F.regexp_replace("value", "#.*", "").alias("value"))
    items = bare.select("line", F.posexplode(F.filter(F.split("value", r"[,\s]+"), lambda x: x != "")).alias("at", "raw_value"))
    Check("ids are positive integers", items.where(~F.col("raw_value").rlike("^0*[1-9][0-9]*$"))).run()
    placed = items.withColumn("position", F.struct("line", "at")).withColumn("id", F.col("raw_value").cast("long"))
    out = accept_first(placed, "id", "position").drop("at")
    if chunk:
        out = out.withColumn("chunk", (F.floor((F.col("accepted_index") - 1) / chunk) + 1).cast("int"))
    return out


def attributes(text: Column | str) -> Column:
    """map of ``key=value;`` attributes, decoded; of repeated keys the first counts; ``+`` stays a plus."""
    t = F.col(text) if isinstance(text, str) else text
    parts = F.filter(F.split(t, ";"), lambda x: x.contains("="))
    pair = lambda x: F.struct(F.trim(F.split_part(x, F.lit("="), F.lit(1))).alias("k"), F.url_decode(F.regexp_replace(F.substr(x, F.instr(x, "=") + 1), r"\+", "%2B")).alias("v"))
    pairs = F.transform(parts, pair)
    keys = F.transform(pairs, lambda p: p["k"])
    return F.map_from_entries(F.filter(pairs, lambda p, i: F.array_position(keys, p["k"]) == i + 1))


GFF3 = ("seqid", "source", "type", "start", "end", "score", "strand", "phase", "attributes")


def gff3(text: DataFrame) -> DataFrame:
    """Nine columns and the attribute map; comments and blank lines go, other widths are an error."""
    rows = text.where((F.col("value") != "") & ~F.col("value").startswith("#")).withColumn("f", F.split("value", "\t", -1))
    Check("annotation lines have nine fields", rows.where(F.size("f") != 9).select("n", "value")).run()
    out = rows.select("n", *(F.nullif(F.col("f")[i], F.lit(".")).alias(c) for i, c in enumerate(GFF3)))
    return out.withColumns({"start": F.col("start").cast("long"), "end": F.col("end").cast("long"), "attributes": attributes("attributes")})


def gene_ids(attrs: Column) -> Column:
    """Numbers of ``GeneID:n`` cross references in the attribute map."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(F.try_element_at(attrs, F.lit("Dbxref")), F.lit("")), F.lit("GeneID:([0-9]+)"), F.lit(1)))


def resolve_parents(features: DataFrame, max_depth: int = 8) -> DataFrame:
    """(id, root): each feature's topmost ancestor by ``id``/``parent``. Cycles and missing parents are errors.

    Pointer jumping halves the depth per round until every pointer has reached a root; more than ``max_depth``
    rounds mean a cycle. Each round is written, so that the plan does not grow.
    """
    up = features.select("id", F.col("parent").alias("up"))
    Check("parents exist", up.where("up is not null").join(features.select(F.col("id").alias("up")), "up", "left_anti")).run()
    up = scratch(up.select("id", "up", F.lit(True).alias("moved")), "parents")
    for _ in range(max_depth + 1):
        top = up.select(F.col("id").alias("up"), F.col("up").alias("top"))
        jumped = up.select("id", "up").join(top, "up", "left")
        jumped = scratch(jumped.select("id", F.coalesce("top", "up").alias("up"), F.col("top").isNotNull().alias("moved")), "parents")
        discard(up)
        up = jumped
        if up.where("moved").isEmpty():
            break
    Check("parents have no cycle", up.where("moved").select("id", "up")).run()
    return up.select("id", F.coalesce("up", "id").alias("root"))


VCF = ("chrom", "pos", "id", "ref", "alt", "qual", "filter", "info")


def vcf(text: DataFrame) -> DataFrame:
    """The first eight fields of record lines; fewer are an error."""
    rows = text.where((F.col("value") != "") & ~F.col("value").startswith("#")).withColumn("f", F.split(F.rtrim("value"), "\t", -1))
    Check("records have eight fields", rows.where(F.size("f") < 8).select("n", "value")).run()
    return rows.select("n", *(F.col("f")[i].alias(c) for i, c in enumerate(VCF))).withColumn("pos", F.col("pos").cast("long"))


def fasta(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(header, sequence, length): one row per record, sequence upper-cased."""
    records = spark.read.option("lineSep", "\n>").text(path)
    text = F.regexp_replace(F.regexp_replace("value", "^>", ""), "\r", "")
    header = F.split_part(text, F.lit("\n"), F.lit(1))
    body = F.upper(F.regexp_replace(F.substr(text, F.char_length(header) + 2), r"\s", ""))
    out = records.where(F.trim("value") != "").select(header.alias("header"), body.alias("sequence"))
    return out.withColumn("length", F.char_length("sequence"))


def fasta_slices(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, record_index, header, length, start_offset, end_offset): where each record lies in its file, in bytes.

    Records are numbered from 1 and counted inside the blocks that a file is read in; a file's blocks, which are few, then add up.
    What comes before the first record only moves offsets.
    """
    raw = spark.read.option("lineSep", "\n>").text(path)
    raw = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"), "value")
    first = (F.col("block") == 0) & (F.row_number().over(Window.partitionBy("file", "block").orderBy("n")) == 1)
    text = F.regexp_replace("value", "\r", "")
    header = F.split_part(text, F.lit("\n"), F.lit(1))
    body = F.regexp_replace(F.substr(text, F.char_length(header) + 2), r"\s", "")
    # texts stay behind: only their measures are sorted
    slim = raw.select(
        "file", "block", "n", (F.octet_length("value") + 2).cast("long").alias("bytes"), header.alias("header"),
        F.char_length(body).cast("long").alias("length"), F.col("value").startswith(">").alias("marked"),
    )
    slim = slim.withColumn("first", first).withColumn("record", (~F.col("first") | F.col("marked")).cast("long"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = slim.groupBy("file", "block").agg(F.sum("bytes").alias("b"), F.sum("record").alias("r"))
    last = F.max("block").over(Window.partitionBy("file")) == F.col("block")
    blocks = blocks.select("file", "block", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("b"), F.coalesce(F.sum("r").over(before), F.lit(0)).alias("r"), last.alias("last"))
    inside = Window.partitionBy("file", "block").orderBy("n")
    placed = slim.withColumns({"to": F.sum("bytes").over(inside), "nth": F.sum("record").over(inside), "open": F.lead("n").over(inside).isNull()}).join(blocks, ["file", "block"])
    end = F.col("b") + F.col("to")
    return placed.where("record = 1").select(
        "file", (F.col("r") + F.col("nth")).alias("record_index"), F.when(F.col("first"), F.substr("header", F.lit(2))).otherwise(F.col("header")).alias("header"), "length",
        F.when(F.col("first"), 0).otherwise(end - F.col("bytes") - 1).alias("start_offset"),
        (end - F.when(F.col("open") & F.col("last"), 2).otherwise(1)).alias("end_offset"),
    )


def header_fields(header: Column | str) -> Column:
    """struct(accession, complement, start1, end1, gene_id, organism, chromosome) of ``acc:[c]from-to name [key=value] ...``."""
    h = F.col(header) if isinstance(header, str) else header
    pick = lambda pattern: F.nullif(F.regexp_extract(h, pattern, 1), F.lit(""))
    ends = [pick(r"^[^:\s]+:c?([0-9]+)-").cast("long"), pick(r"^[^:\s]+:c?[0-9]+-([0-9]+)").cast("long")]
    return F.struct(
        pick(r"^([^:\s]+)").alias("accession"), h.rlike(r"^[^:\s]+:c[0-9]").alias("complement"), F.least(*ends).alias("start1"),
        F.greatest(*ends).alias("end1"), pick(r"\[GeneID=([0-9]+)\]").alias("gene_id"), pick(r"\[organism=([^\]]+)\]").alias("organism"),
        pick(r"\[chromosome=([^\]]+)\]").alias("chromosome"),
    )


PAF = ("query", "query_length", "query_start", "query_end", "strand", "target", "target_length", "target_start", "target_end", "matches", "block", "mapq")


def paf(text: DataFrame) -> DataFrame:
    """Twelve fields, tags as a map, and a record id from the line's content and its occurrence."""
    rows = text.where(F.col("value") != "").withColumn("f", F.split("value", "\t", -1))
    Check("alignment lines have twelve fields", rows.where(F.size("f") < 12).select("n", "value")).run()
    digest = F.sha2("value", 256)
    nth = F.row_number().over(Window.partitionBy(digest).orderBy("n"))
    tags = F.map_from_entries(F.transform(
        F.filter(F.slice("f", F.lit(13), F.greatest(F.size("f") - 12, F.lit(0))), lambda t: t.rlike("^[A-Za-z][A-Za-z0-9]:[A-Za-z]:")),
        lambda t: F.struct(F.left(t, F.lit(2)), F.substr(t, F.lit(6))),
    ))
    out = rows.select(F.concat_ws(":", digest, nth.cast("string")).alias("record_id"), "n", *(F.col("f")[i].alias(c) for i, c in enumerate(PAF)), tags.alias("tags"))
    numbers = [c for c in PAF if c not in ("query", "strand", "target")]
    return out.withColumns({c: F.col(c).cast("long") for c in numbers})


SAM = ("query", "flag", "target", "pos1", "mapq", "cigar", "mate", "mate_pos", "template", "sequence", "quality")


def sam(text: DataFrame) -> DataFrame:
    """Alignment lines: eleven fields, the NM tag, target start (0-based) and whether it is mapped."""
    rows = text.where((F.col("value") != "") & ~F.col("value").startswith("@")).withColumn("f", F.split("value", "\t", -1))
    Check("alignment lines have eleven fields", rows.where(F.size("f") < 11).select("n", "value")).run()
    out = rows.select("n", *(F.col("f")[i].alias(c) for i, c in enumerate(SAM)), F.nullif(F.regexp_extract("value", r"\tNM:i:([0-9]+)", 1), F.lit("")).cast("long").alias("mismatches"))
    out = out.withColumns({c: F.col(c).cast("long") for c in ("flag", "pos1", "mapq")})
    return out.withColumns({"start0": F.col("pos1") - 1, "mapped": F.col("flag").bitwiseAND(4) == 0})


def json_groups(spark: SparkSession, path: str, schema: StructType | str, group: str, requested: DataFrame, key: str) -> DataFrame:
    """Nested JSON lines with an array of groups; each record gets its first group item whose ``key`` is requested."""
    records = spark.read.schema(schema).json(path).withColumn("_r", F.monotonically_increasing_id())
    items = records.select("_r", F.posexplode_outer(group).alias("at", "item"))
    hit = items.select("_r", "at", F.col("item")[key].alias("query_id")).join(requested.select(F.col(key).alias("query_id")), "query_id", "left_semi")
    first = hit.groupBy("_r").agg(F.min_by("query_id", "at").alias("query_id"))
    return records.join(first, "_r", "left").drop("_r")


def track_scores(requests: DataFrame, track: DataFrame, axis: str, pos: str, score: str, width: int) -> DataFrame:
    """Scores of positions from a track stored with a ``tile`` column: the tile prunes files, the position joins."""
    tiled = requests.withColumn("tile", F.floor((F.col(pos) - 1) / width) * width + 1)
    return tiled.join(track.select(axis, "tile", pos, score), [axis, "tile", pos], "left").drop("tile")


def read_blocks(positions: DataFrame, axis: str, pos: str, max_span: int, max_gap: int) -> DataFrame:
    """(axis, start, end, positions): blocks to read, of near positions and at most ``max_span`` long."""
    clustered = gap_clusters(positions.select(axis, pos).distinct(), [axis], pos, max_gap)
    first = F.min(pos).over(Window.partitionBy(axis, "cluster"))
    cut = clustered.withColumn("part", F.floor((F.col(pos) - first) / max_span))
    return cut.groupBy(axis, "cluster", "part").agg(F.min(pos).alias("start"), F.max(pos).alias("end"), F.count("*").alias("positions")).drop("cluster", "part")
