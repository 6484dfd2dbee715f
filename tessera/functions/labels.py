"""Classification ladders: clinical significance, review levels, lookup status, consequences, frequencies."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Review statuses and their star levels.
REVIEW_STARS = {
    "practice_guideline": 4,
    "reviewed_by_expert_panel": 3,
    "criteria_provided,_multiple_submitters,_no_conflicts": 2,
    "criteria_provided,_multiple_submitters": 2,
    "criteria_provided,_conflicting_classifications": 1,
    "criteria_provided,_conflicting_interpretations": 1,
    "criteria_provided,_single_submitter": 1,
    "no_assertion_criteria_provided": 0,
    "no_assertion_provided": 0,
    "no_classification_provided": 0,
    "no_classification_for_the_individual_variant": 0,
}

# Consequence terms from the most to the least severe.
SEVERITY = (
    "transcript_ablation", "splice_acceptor_variant", "splice_donor_variant", "stop_gained", "frameshift_variant", "stop_lost",
    "start_lost", "transcript_amplification", "feature_elongation", "feature_truncation", "inframe_insertion", "inframe_deletion",
    "missense_variant", "protein_altering_variant", "splice_donor_5th_base_variant", "splice_region_variant",
    "splice_donor_region_variant", "splice_polypyrimidine_tract_variant", "incomplete_terminal_codon_variant",
    "start_retained_variant", "stop_retained_variant", "synonymous_variant", "coding_sequence_variant", "mature_miRNA_variant",
    "5_prime_UTR_variant", "3_prime_UTR_variant", "non_coding_transcript_exon_variant", "intron_variant", "NMD_transcript_variant",
    "non_coding_transcript_variant", "coding_transcript_variant", "upstream_gene_variant", "downstream_gene_variant",
    "TFBS_ablation", "TFBS_amplification", "TF_binding_site_variant", "regulatory_region_ablation",
    "regulatory_region_amplification", "regulatory_region_variant", "intergenic_variant", "sequence_variant",
)

# Non-exclusive consequence groups.
GROUPS = {
    "missense": ("missense_variant",),
    "synonymous": ("synonymous_variant", "stop_retained_variant"),
    "protein_truncating": ("frameshift_variant", "nonsense", "start_lost", "stop_gained", "transcript_ablation"),
    "canonical_splice": ("splice_acceptor_variant", "splice_donor_variant"),
    "inframe_protein_altering": (
        "coding_sequence_variant", "inframe_deletion", "inframe_insertion", "protein_altering_variant", "stop_lost",
    ),
    "splice_region": (
        "splice_donor_5th_base_variant", "splice_donor_region_variant", "splice_polypyrimidine_tract_variant", "splice_region_variant",
    ),
    "intronic": ("intron_variant",),
    "utr_noncoding": (
        "3_prime_UTR_variant", "5_prime_UTR_variant", "downstream_gene_variant", "mature_miRNA_variant",
        "non_coding_transcript_exon_variant", "non_coding_transcript_variant", "non-coding_transcript_variant",
        "regulatory_region_ablation", "regulatory_region_amplification", "regulatory_region_variant", "TF_binding_site_variant",
        "upstream_gene_variant",
    ),
}
OTHER_GROUP = "other"

# Exclusive display groups.
DISPLAY_GROUPS = {
    "LoF/splice": (
        "frameshift_variant", "splice_acceptor_variant", "splice_donor_variant", "start_lost", "stop_gained", "stop_lost",
    ),
    "Missense/inframe": ("inframe_deletion", "inframe_insertion", "missense_variant", "protein_altering_variant"),
    "Synonymous": ("stop_retained_variant", "synonymous_variant"),
    "Noncoding/UTR/intron": (
        "3_prime_UTR_variant", "5_prime_UTR_variant", "intron_variant", "non_coding_transcript_exon_variant", "splice_region_variant",
    ),
}
NOT_ANNOTATED = "__not_annotated__"

# Score band limits.
BAND_LOW, BAND_HIGH = -1.30103, 1.30103


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _status(value: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(value)), " ", "_")


def set_items(text: Column | str, separator: str = "|") -> Column:
    """The trimmed, non-empty items of set-valued text, in order."""
    parts = F.split(F.coalesce(_c(text), F.lit("")), rf"[{separator}]")
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")


def set_text(items: Column, separator: str = "|") -> Column:
    """Distinct items, sorted and joined."""
    return F.array_join(F.array_sort(F.array_distinct(items)), separator)


def flags_text(text: Column | str) -> Column:
    """Cleans a flag list that mixes ``,`` and ``|``: no empties, distinct, sorted, joined by ``|``."""
    return set_text(set_items(text, ",|"))


def significance_class(value: Column | str) -> Column:
    """P/LP, B/LB, VUS or Other; null for null or empty text. The order of the rungs matters."""
    t = F.lower(_c(value))
    benign, pathogenic = t.contains("benign"), t.contains("pathogenic")
    return (
        F.when(F.coalesce(t, F.lit("")) == "", None)
        .when(t.contains("conflicting"), "Other")
        .when(t.rlike("uncertain|vus"), "VUS")
        .when(benign & ~pathogenic, "B/LB")
        .when(pathogenic & ~benign, "P/LP")
        .otherwise("Other")
    )


def record_category(value: Column | str, found: Column) -> Column:
    return F.when(~found, "Not in ClinVar").otherwise(F.coalesce(significance_class(value), F.lit("Unclassified")))


def pathogenic_subtype(value: Column | str) -> Column:
    """struct(subtype, low_penetrance) of a pathogenic significance text; (null, false) for others."""
    t = _status(_c(value))
    items = F.transform(F.split(t, r"\|"), lambda x: F.regexp_replace(x, "[,/]_?low_penetrance", ""))
    both = F.exists(items, lambda x: x.contains("pathogenic/likely_pathogenic"))
    likely = F.exists(items, lambda x: x.contains("likely_pathogenic"))
    plain = F.exists(items, lambda x: x.contains("pathogenic") & ~x.contains("likely_pathogenic"))
    subtype = (
        F.when(both | (likely & plain), "Pathogenic / likely pathogenic").when(likely, "Likely pathogenic")
        .when(plain, "Pathogenic").otherwise("Pathogenic / likely pathogenic")
    )
    is_p = F.coalesce(significance_class(value) == "P/LP", F.lit(False))
    return F.struct(
        F.when(is_p, subtype).alias("subtype"), (is_p & F.coalesce(t.contains("low_penetrance"), F.lit(False))).alias("low_penetrance")
    )


def review_stars(value: Column | str) -> Column:
    """struct(stars, status): status is mapped, missing, unmapped:<first> or ambiguous_multiple_review_statuses."""
    items = F.transform(F.filter(F.split(F.coalesce(_c(value), F.lit("")), r"\|"), lambda x: x != ""), _status)
    table = F.create_map(*(F.lit(x) for pair in REVIEW_STARS.items() for x in pair))
    stars = F.transform(items, lambda x: F.try_element_at(table, x))
    unknown = F.get(F.filter(items, lambda x: F.try_element_at(table, x).isNull()), F.lit(0))
    distinct = F.array_distinct(stars)
    status = (
        F.when(F.size(items) == 0, "missing").when(unknown.isNotNull(), F.concat(F.lit("unmapped:"), unknown))
        .when(F.size(distinct) > 1, "ambiguous_multiple_review_statuses").otherwise("mapped")
    )
    return F.struct(F.when(status == "mapped", F.get(distinct, F.lit(0))).alias("stars"), status.alias("status"))


def lookup_status(found: Column, failed: Column, *, found_first: bool = True) -> Column:
    """found / lookup_failed / not_found; ``found_first`` tells which of two true flags wins."""
    f, x = F.coalesce(found, F.lit(False)), F.coalesce(failed, F.lit(False))
    if found_first:
        return F.when(f, "found").when(x, "lookup_failed").otherwise("not_found")
    return F.when(x, "lookup_failed").when(f, "found").otherwise("not_found")


def consequence_or_default(term: Column | str, status: Column | str, default: str = NOT_ANNOTATED) -> Column:
    return F.when((_c(status) == "ok") & (F.coalesce(_c(term), F.lit("")) != ""), _c(term)).otherwise(default)


def consequence_groups(terms: Column | str) -> Column:
    """Sorted-by-definition array of the groups of pipe-listed terms; unknown or no terms also give ``other``."""
    items = set_items(terms)
    known = F.array(*(F.lit(t) for ts in GROUPS.values() for t in ts))
    found = [F.when(F.arrays_overlap(items, F.array(*map(F.lit, ts))), g) for g, ts in GROUPS.items()]
    other = F.when((F.size(items) == 0) | (F.size(F.array_except(items, known)) > 0), OTHER_GROUP)
    return F.array_compact(F.array(*found, other))


def consequence_mask(terms: Column | str) -> Column:
    """One bit per group, in the order of ``GROUPS``, ``other`` last."""
    groups = consequence_groups(terms)
    bits = [F.when(F.array_contains(groups, g), 1 << k).otherwise(0) for k, g in enumerate((*GROUPS, OTHER_GROUP))]
    return reduce(lambda a, b: a + b, bits).cast("long")


def display_group(term: Column | str) -> Column:
    t = _c(term)
    out = F.when(t == NOT_ANNOTATED, "Not annotated")
    for group, terms in DISPLAY_GROUPS.items():
        out = out.when(t.isin(*terms), group)
    return out.otherwise("Other")


def severity_rank(term: Column | str) -> Column:
    """Position in ``SEVERITY``; unknown terms come after all known ones."""
    place = F.array_position(F.array(*map(F.lit, SEVERITY)), _c(term))
    return F.when(place > 0, place - 1).otherwise(len(SEVERITY)).cast("int")


def by_severity(terms: Column) -> Column:
    """Distinct terms, most severe first, unknown ones last in text order."""
    ranked = F.array_sort(F.transform(F.array_distinct(terms), lambda t: F.struct(severity_rank(t).alias("r"), t.alias("t"))))
    return F.transform(ranked, lambda x: x["t"])


def severity_table(spark: SparkSession) -> DataFrame:
    """The severity order as a dimension (term, severity) of fixed size."""
    return spark.createDataFrame([(t, k) for k, t in enumerate(SEVERITY)], "term string, severity int")


def score_band(value: Column | str) -> Column:
    """acceleration / central / conservation; null for null and NaN (NaN would compare as largest)."""
    v = _c(value).cast("double")
    ok = v.isNotNull() & ~F.isnan(v)
    return F.when(ok & (v <= BAND_LOW), "acceleration").when(ok & (v >= BAND_HIGH), "conservation").when(ok, "central")


def selected_frequency(joint_count: Column, joint_number: Column, exome: Column, genome: Column) -> Column:
    """struct(af, source): joint count / number where usable, then exome, then genome."""
    joint = F.when((joint_number > 0) & (joint_count >= 0), joint_count / joint_number)
    source = F.when(joint.isNotNull(), "joint").when(exome.isNotNull(), "exome").when(genome.isNotNull(), "genome")
    return F.struct(F.coalesce(joint, exome, genome).alias("af"), source.alias("source"))


def log10_positive(value: Column | str) -> Column:
    """log10, null for zero and below."""
    return F.when(_c(value) > 0, F.log10(_c(value)))


def info_value(info: Column | str, key: str) -> Column:
    """First ``key=value`` in semicolon-separated text; null if absent."""
    hits = F.filter(F.split(_c(info), ";"), lambda x: x.startswith(f"{key}="))
    return F.substr(F.get(hits, F.lit(0)), F.lit(len(key) + 2))


def consequence_pairs(text: Column | str) -> Column:
    """array<struct<id, term>> of comma-listed ``id|term``, distinct in order of first occurrence."""
    items = F.filter(F.split(F.coalesce(_c(text), F.lit("")), ","), lambda x: x.contains("|"))
    return F.array_distinct(F.transform(items, lambda x: F.struct(
        F.split_part(x, F.lit("|"), F.lit(1)).alias("id"), F.split_part(x, F.lit("|"), F.lit(2)).alias("term"))))


# Placeholders that name no condition, and id prefixes by priority.
CONDITION_PLACEHOLDERS = ("", ".", "not_provided", "not_specified")
ID_PRIORITY = ("MedGen:", "MONDO:", "OMIM:")


def conditions(names: Column | str, ids: Column | str) -> Column:
    """array<struct<key, name>>: conditions of pipe-listed names paired with pipe-listed id lists.

    The key is the first id of the best prefix, else all ids, else the name; placeholders go, the
    first of equal keys stays.
    """
    decode = lambda x: F.url_decode(F.regexp_replace(x, r"\+", "%2B"))
    pairs = F.arrays_zip(
        F.split(F.coalesce(_c(names), F.lit("")), r"\|").alias("name"), F.split(F.coalesce(_c(ids), F.lit("")), r"\|").alias("ids")
    )

    def one(x: Column) -> Column:
        name = F.regexp_replace(F.trim(decode(F.coalesce(x["name"], F.lit("")))), " ", "_")
        own = F.filter(F.split(F.coalesce(x["ids"], F.lit("")), ","), lambda i: (i != "") & (i != "."))
        best = [F.get(F.filter(own, _prefixed(p)), F.lit(0)) for p in ID_PRIORITY]
        key = F.coalesce(*best, F.nullif(F.array_join(own, ","), F.lit("")), name)
        return F.struct(key.alias("key"), name.alias("name"))

    all_of = F.filter(F.transform(pairs, one), lambda x: ~F.lower(x["name"]).isin(*CONDITION_PLACEHOLDERS))
    keys = F.transform(all_of, lambda x: x["key"])
    return F.filter(all_of, lambda x, i: F.array_position(keys, x["key"]) == i + 1)


def _prefixed(prefix: str):
    return lambda i: i.startswith(prefix)


# ---------------------------------------------------------------- numbers and times as text


def _c_text(form: str, value: Column) -> Column:
    """A double by a format of C, from its exact binary value. The JVM's formatter starts from the shortest decimal form instead."""

    @F.pandas_udf("string")
    def text(values: pd.Series) -> pd.Series:
        return pd.Series([form % v for v in values], dtype=object)

    v = value.cast("double")
    return F.when(v.isNotNull(), text(v))


def fixed_text(value: Column | str, digits: int = 6) -> Column:
    """A number with ``digits`` decimals, as ``%.6f`` of C; null stays null."""
    return _c_text(f"%.{digits}f", _c(value))


def general_text(value: Column | str, digits: int = 6) -> Column:
    """A number with ``digits`` significant digits, as ``%.6g`` of C: no trailing zeros, an exponent below 1e-4 and from 1e6 on."""
    return _c_text(f"%.{digits}g", _c(value))


def utc_micros(text: Column | str) -> Column:
    """Microseconds of an ISO 8601 time in UTC (``Z`` or ``+00:00``); null for any other text."""
    t = _c(text)
    shape = t.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]{1,6})?(?:Z|\+00:00)$")
    return F.when(shape, F.unix_micros(F.try_to_timestamp(t)))
