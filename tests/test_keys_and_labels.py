import pytest
from pyspark.sql import functions as F

from tessera.functions import keys as K
from tessera.functions import labels as L


def one(spark, **columns):
    """Evaluates expressions over literals."""
    return spark.range(1).select(*(v.alias(k) for k, v in columns.items())).first()


@pytest.mark.parametrize(
    "key, valid",
    [("1:10:A>G", True), ("chr1:10:A>GT", True), ("1:0:A>G", False), ("1:10:A>N", False), (":10:A>G", False), ("1:10:A", False), ("1:10:A>G>C", False), (None, False), ("", False)],
)
def test_key_validity(spark, key, valid):
    assert one(spark, v=K.key_is_valid(F.lit(key)))["v"] is valid


def test_key_parts_and_names(spark):
    r = one(spark, k=K.key_struct(F.lit("chrM:15:a>gt")), t=K.key_text(F.lit("1"), F.lit(5), F.lit("A"), F.lit("G")))
    assert (r["k"]["axis"], r["k"]["pos"], r["k"]["ref"], r["k"]["alt"], r["t"]) == ("MT", 15, "A", "GT", "1:5:A>G")


@pytest.mark.parametrize("value, axis", [("NC_000023.11", "X"), ("NC_000001.11", "1"), ("NC_012920.1", "MT"), ("24", "Y"), ("chrX", "X"), ("NW_1", None), ("", None), (None, None), ("007", "7")])
def test_axis_of_accession(spark, value, axis):
    assert one(spark, v=K.axis_of_accession(F.lit(value).cast("string")))["v"] == axis


@pytest.mark.parametrize("ref, alt, kind, subtype, prefix", [("A", "G", "snv", "snv", 0), ("A", "AG", "indel", "insertion", 1), ("ACT", "A", "indel", "deletion", 1), ("AC", "AG", "complex", "other", 1), ("A", "N", "unsupported", "snv", 0)])
def test_change_types(spark, ref, alt, kind, subtype, prefix):
    r = one(spark, k=K.change_type(F.lit(ref), F.lit(alt)), s=K.change_subtype(F.lit(ref), F.lit(alt)), p=K.common_prefix(F.lit(ref), F.lit(alt)))
    assert (r["k"], r["s"], r["p"]) == (kind, subtype, prefix)


def test_common_prefix_of_empty_text(spark):
    assert one(spark, p=K.common_prefix(F.lit(""), F.lit("A")))["p"] == 0


@pytest.mark.parametrize("ref, alt, positions", [("A", "G", [10]), ("ACT", "A", [11, 12]), ("A", "AGG", [10, 11]), ("AC", "GT", []), ("CAC", "CGC", [11])])
def test_score_offsets(spark, ref, alt, positions):
    assert one(spark, p=K.score_offsets(F.lit(10), F.lit(ref), F.lit(alt)))["p"] == positions


def test_bins_tiles_and_orders(spark):
    r = one(spark, a=K.power_bin(F.lit(0)), b=K.power_bin_label(F.lit(5)), c=K.tile_start(F.lit(25001), 25000), d=K.block_id(F.lit("1"), F.lit(10_000_001)), e=K.block_id(F.lit(None).cast("string"), F.lit(1)), f=K.reverse_complement(F.lit("AACGn")))
    assert tuple(r) == (0, "4-7", 25001, "1_1", "invalid", "nCGTT")


def test_alignment_columns(spark):
    r = one(spark, a=K.alignment_role(F.lit(2048)), b=K.cigar_length(F.lit("5S10M2I3D")), c=K.alignment_identity(F.lit("8M2I"), F.lit(2)), d=K.lifted_span(F.lit(100), F.lit(50), F.lit(5), F.lit(15), F.lit("-"), F.lit(0)))
    assert (r["a"], r["b"], r["c"]) == ("supplementary", 15, 0.8)
    assert (r["d"]["start0"], r["d"]["end0"]) == (135, 145)


@pytest.mark.parametrize(
    "text, cls",
    [("Pathogenic", "P/LP"), ("Likely_benign", "B/LB"), ("Conflicting_interpretations_of_pathogenicity", "Other"), ("Uncertain significance", "VUS"), ("Benign|Pathogenic", "Other"), ("drug response", "Other"), ("", None), (None, None)],
)
def test_significance(spark, text, cls):
    assert one(spark, v=L.significance_class(F.lit(text).cast("string")))["v"] == cls


@pytest.mark.parametrize(
    "text, subtype, low",
    [("Pathogenic", "Pathogenic", False), ("Likely_pathogenic,_low_penetrance", "Likely pathogenic", True), ("Pathogenic/Likely_pathogenic", "Pathogenic / likely pathogenic", False), ("Pathogenic|Likely pathogenic", "Pathogenic / likely pathogenic", False), ("Benign", None, False)],
)
def test_pathogenic_subtype(spark, text, subtype, low):
    assert tuple(one(spark, v=L.pathogenic_subtype(F.lit(text)))["v"]) == (subtype, low)


@pytest.mark.parametrize(
    "text, stars, status",
    [("practice_guideline", 4, "mapped"), ("criteria provided, single submitter", 1, "mapped"), ("", None, "missing"), (None, None, "missing"), ("new_status", None, "unmapped:new_status"), ("practice_guideline|no_assertion_provided", None, "ambiguous_multiple_review_statuses")],
)
def test_review_stars(spark, text, stars, status):
    assert tuple(one(spark, v=L.review_stars(F.lit(text).cast("string")))["v"]) == (stars, status)


def test_consequences(spark):
    r = one(
        spark, a=L.consequence_groups(F.lit("missense_variant|intron_variant")), b=L.consequence_groups(F.lit("")), c=L.consequence_mask(F.lit("missense_variant|odd")),
        d=L.display_group(F.lit("stop_lost")), e=L.by_severity(F.array(F.lit("zz"), F.lit("intron_variant"), F.lit("stop_gained"), F.lit("aa"))), f=L.severity_rank(F.lit("odd")),
    )
    assert (r["a"], r["b"], r["c"], r["d"], r["e"], r["f"]) == (["missense", "intronic"], ["other"], 1 + 256, "LoF/splice", ["stop_gained", "intron_variant", "aa", "zz"], 41)


def test_bands_frequency_and_lists(spark):
    nan = F.lit(float("nan"))
    r = one(spark, a=L.score_band(F.lit(-1.30103)), b=L.score_band(nan), c=L.score_band(F.lit(0.0)), d=L.selected_frequency(F.lit(3), F.lit(0), F.lit(0.2), F.lit(0.1)), e=L.selected_frequency(F.lit(3), F.lit(6), F.lit(0.2), F.lit(0.1)), f=L.flags_text(F.lit("b,a|a,,c")), g=L.log10_positive(F.lit(0.0)))
    assert (r["a"], r["b"], r["c"], tuple(r["d"]), tuple(r["e"]), r["f"], r["g"]) == ("acceleration", None, "central", (0.2, "exome"), (0.5, "joint"), "a|b|c", None)


def test_info_and_conditions(spark):
    names, ids = "not_provided|Disease_three%2C x|Disease_one|Disease_one", ".|MedGen:C2,OMIM:7|MONDO:MONDO:1,OMIM:1|MONDO:MONDO:1"
    r = one(spark, a=L.info_value(F.lit("X=1;CLNSIG=a=b;CLNSIG=c"), "CLNSIG"), b=L.info_value(F.lit("X=1"), "Y"), c=L.conditions(F.lit(names), F.lit(ids)), d=L.consequence_pairs(F.lit("SO:1|mis,SO:1|mis,SO:2|syn")))
    assert (r["a"], r["b"]) == ("a=b", None)
    assert [tuple(x) for x in r["c"]] == [("MedGen:C2", "Disease_three,_x"), ("MONDO:MONDO:1", "Disease_one")]
    assert [tuple(x) for x in r["d"]] == [("SO:1", "mis"), ("SO:2", "syn")]


def test_lookup_ladders(spark):
    t, f = F.lit(True), F.lit(False)
    r = one(spark, a=L.lookup_status(t, t), b=L.lookup_status(t, t, found_first=False), c=L.lookup_status(f, t), d=L.lookup_status(F.lit(None).cast("boolean"), f))
    assert tuple(r) == ("found", "lookup_failed", "lookup_failed", "not_found")


def test_number_texts_round_the_exact_binary_value(spark):
    values = [217243.3274395, 0.0078125, 2.5e-6, 1.0000005, 0.3, 123456.5, 1234575.0, 1.5e-7, 99999.95, 123456789012345678.0, 1e22, 0.0, -0.0, -2.0, float("inf"), float("-inf"), float("nan"), None]
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v double").select("k", L.fixed_text("v").alias("f"), L.general_text("v").alias("g"))
    got = {r["k"]: (r["f"], r["g"]) for r in rows.collect()}
    assert [got[k] for k in range(len(values))] == [(None, None) if v is None else ("%.6f" % v, "%.6g" % v) for v in values]
    assert got[0] == ("217243.327439", "217243") and got[5][1] == "123456"
