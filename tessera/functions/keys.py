"""Column expressions over item keys ``axis:position:from>to`` and their coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_PATTERN = r"\A(?:chr)?[^:>]+:[0-9]+:[ACGT]+>[ACGT]+\z"

# IUPAC nucleotide codes and their complements.
IUPAC = "ACGTURYSWKMBDHVN"
IUPAC_COMPLEMENT = "TGCAAYRSWMKVHDBN"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def axis_name(value: Column | str) -> Column:
    """Trimmed axis name without a leading ``chr``; ``M`` is ``MT``; empty is null."""
    bare = F.regexp_replace(F.trim(_c(value)), r"\Achr", "")
    return F.when(bare == "M", "MT").when(bare != "", bare)


def axis_of_accession(value: Column | str) -> Column:
    """Axis name of a name, a number or a versioned reference accession; null if unknown."""
    name = axis_name(value)
    digits = F.regexp_extract(name, r"NC_0+([0-9]+)\.", 1)
    number = F.when(name.rlike(r"\A[0-9]+\z"), name).when(digits != "", digits).try_cast("long")
    from_number = (
        F.when(number == 23, "X").when(number == 24, "Y")
        .when((digits != "") & number.isin(12920, 1807), "MT").otherwise(number.cast("string"))
    )
    return F.when(name.isin("X", "Y", "MT"), name).otherwise(from_number)


def key_struct(key: Column | str) -> Column:
    """struct(axis, pos, ref, alt) of a key; null fields where a part is missing."""
    k = _c(key)
    alleles = F.split_part(k, F.lit(":"), F.lit(3))
    part = lambda s, sep, n: F.nullif(F.split_part(s, F.lit(sep), F.lit(n)), F.lit(""))
    return F.struct(
        axis_name(F.split_part(k, F.lit(":"), F.lit(1))).alias("axis"),
        F.split_part(k, F.lit(":"), F.lit(2)).try_cast("long").alias("pos"),
        F.upper(part(alleles, ">", 1)).alias("ref"),
        F.upper(part(alleles, ">", 2)).alias("alt"),
    )


def key_is_valid(key: Column | str) -> Column:
    """Two colons, one arrow, concrete bases and a positive position; null is not valid."""
    k = _c(key)
    pos = F.split_part(k, F.lit(":"), F.lit(2)).try_cast("long")
    return F.coalesce(k.rlike(KEY_PATTERN) & (pos > 0), F.lit(False))


def key_text(axis: Column | str, pos: Column | str, ref: Column | str, alt: Column | str) -> Column:
    return F.concat(_c(axis), F.lit(":"), _c(pos).cast("string"), F.lit(":"), _c(ref), F.lit(">"), _c(alt))


def item_id(key: Column | str, group: Column | str, kind: Column | str, ref: Column | str, alt: Column | str) -> Column:
    """The key, or ``group:kind:ref>alt`` where the key is null or empty."""
    k = _c(key)
    g, t, r, a = (F.coalesce(_c(x), F.lit("")) for x in (group, kind, ref, alt))
    fallback = F.concat(g, F.lit(":"), t, F.lit(":"), r, F.lit(">"), a)
    return F.when(F.coalesce(k, F.lit("")) != "", k).otherwise(fallback)


def concrete(allele: Column | str) -> Column:
    return F.coalesce(F.upper(_c(allele)).rlike(r"\A[ACGT]+\z"), F.lit(False))


def change_type(ref: Column | str, alt: Column | str) -> Column:
    """snv, indel, complex, or unsupported where an allele is not concrete."""
    r, a = F.char_length(_c(ref)), F.char_length(_c(alt))
    return (
        F.when(~(concrete(ref) & concrete(alt)), "unsupported")
        .when((r == 1) & (a == 1), "snv").when(r != a, "indel").otherwise("complex")
    )


def change_subtype(ref: Column | str, alt: Column | str) -> Column:
    """snv, insertion, deletion or other, by lengths."""
    r, a = F.char_length(_c(ref)), F.char_length(_c(alt))
    return F.when((r == 1) & (a == 1), "snv").when(a > r, "insertion").when(a < r, "deletion").otherwise("other")


def substitution_class(ref: Column | str, alt: Column | str) -> Column:
    """transition or transversion of a single-base change, else null."""
    pair = F.concat(F.upper(_c(ref)), F.upper(_c(alt)))
    single = (F.char_length(_c(ref)) == 1) & (F.char_length(_c(alt)) == 1) & (F.upper(_c(ref)) != F.upper(_c(alt)))
    return F.when(single, F.when(pair.isin("AG", "GA", "CT", "TC"), "transition").otherwise("transversion"))


def common_prefix(a: Column | str, b: Column | str) -> Column:
    """Length of the longest common prefix. ``sequence(1, 0)`` would count down, hence the guard."""
    x, y = _c(a), _c(b)
    n = F.least(F.char_length(x), F.char_length(y))
    same = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.left(x, i) == F.left(y, i))
    return F.when(n > 0, F.coalesce(F.array_max(same), F.lit(0))).otherwise(0)


def changed_offset(pos: Column | str, begin: Column | str, ref: Column | str, alt: Column | str) -> Column:
    """Zero-based offset from ``begin`` of the first position that a change affects."""
    return _c(pos) - _c(begin) + common_prefix(ref, alt)


def score_offsets(pos: Column | str, ref: Column | str, alt: Column | str) -> Column:
    """Positions whose scores describe a change: the substituted base, the deleted bases, the two
    bases around an insertion; empty for complex changes."""
    p, r, a = _c(pos), _c(ref), _c(alt)
    lead = common_prefix(r, a)
    r1, a1 = F.substr(r, lead + 1), F.substr(a, lead + 1)
    tail = common_prefix(F.reverse(r1), F.reverse(a1))
    nr, na = F.char_length(r1) - tail, F.char_length(a1) - tail
    at = (p + lead).cast("long")
    none = F.expr("cast(array() as array<bigint>)")
    return (
        F.when((nr == 1) & (na == 1), F.array(at))
        .when((nr > 0) & (na == 0), F.sequence(at, at + F.greatest(nr, F.lit(1)) - 1))
        .when((nr == 0) & (na > 0), F.array(at - 1, at))
        .otherwise(none)
    )


def tile_start(pos: Column | str, width: int) -> Column:
    """First position of the fixed-width tile that holds a one-based position."""
    return F.floor((_c(pos) - 1) / width) * width + 1


def block_id(axis: Column | str, pos: Column | str, width: int = 10_000_000) -> Column:
    """``axis_n`` of a storage block, or ``invalid``."""
    block = F.concat_ws("_", _c(axis), F.floor((_c(pos) - 1) / width).cast("string"))
    return F.when(_c(axis).isNotNull() & (_c(pos) > 0), block).otherwise("invalid")


def axis_order(axis: Column | str) -> Column:
    """Sort key of axes: numbers by value, then X, Y, MT, then others."""
    a = _c(axis)
    return F.coalesce(a.try_cast("int"), F.when(a == "X", 1001).when(a == "Y", 1002).when(a.isin("M", "MT"), 1003).otherwise(2000))


def reverse_complement(sequence: Column | str) -> Column:
    both, to = IUPAC + IUPAC.lower(), IUPAC_COMPLEMENT + IUPAC_COMPLEMENT.lower()
    return F.reverse(F.translate(_c(sequence), both, to))


def power_bin(n: Column | str) -> Column:
    """Bit length of a count: 0, 1, 2 (2-3), 3 (4-7) and so on."""
    v = _c(n).cast("long")
    return F.when(v <= 0, 0).otherwise(F.char_length(F.bin(v)))


def power_bin_label(n: Column | str) -> Column:
    order = power_bin(n)
    low = F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest(order - 1, F.lit(0)))
    return F.when(order <= 1, order.cast("string")).otherwise(F.concat_ws("-", low.cast("string"), (low * 2 - 1).cast("string")))


def source_span(begin: Column | str, start0: Column | str, end0: Column | str) -> Column:
    """struct(start1, end1): one-based inclusive span of a half-open offset interval; a point for an empty one."""
    b, s, e = _c(begin), _c(start0), _c(end0)
    return F.struct((b + s).alias("start1"), F.when(e > s, b + e - 1).otherwise(b + s).alias("end1"))


def alignment_role(flag: Column | str) -> Column:
    """primary, secondary, supplementary or both, by alignment flag bits."""
    sec, sup = _c(flag).bitwiseAND(256) != 0, _c(flag).bitwiseAND(2048) != 0
    return F.when(sec & sup, "secondary_supplementary").when(sec, "secondary").when(sup, "supplementary").otherwise("primary")


def cigar_length(cigar: Column | str, operations: str = "MID=X") -> Column:
    """Summed length of the given operations."""
    found = F.regexp_extract_all(_c(cigar), F.lit(rf"([0-9]+)[{operations}]"), F.lit(1))
    return F.aggregate(found, F.lit(0).cast("long"), lambda acc, x: acc + x.cast("long"))


def alignment_identity(cigar: Column | str, mismatches: Column | str) -> Column:
    """max(0, block - mismatches) / block over the aligned block; null for an empty block."""
    block = cigar_length(cigar)
    return F.when(block > 0, F.greatest(F.lit(0), block - _c(mismatches)) / block)


def lifted_span(read_start: Column | str, read_length: Column | str, q_start: Column | str, q_end: Column | str, strand: Column | str, clip: Column | str) -> Column:
    """A window-local query interval on its source sequence: shifted by the hard clip, flipped on the reverse strand."""
    s, e = _c(q_start) + _c(clip), _c(q_end) + _c(clip)
    flipped = F.struct((_c(read_start) + _c(read_length) - e).alias("start0"), (_c(read_start) + _c(read_length) - s).alias("end0"))
    return F.when(_c(strand) == "-", flipped).otherwise(F.struct((_c(read_start) + s).alias("start0"), (_c(read_start) + e).alias("end0")))
