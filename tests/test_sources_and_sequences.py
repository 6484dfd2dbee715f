import json
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import sequence as Q
from tessera.operators.contracts import DataContractError
from tessera.sources import formats as S
from tessera.sources import tables as T


def text(spark, *values):
    return spark.createDataFrame([(k, v) for k, v in enumerate(values)], "n long, value string")


def test_id_list(spark, rows):
    out = S.id_list(text(spark, "# panel", "672, 7157", "672", "5728 1956,4609"), chunk=2)
    got = rows(out, "line", "id", "accepted", "accepted_index", "duplicate_of_index", "chunk")
    assert got == sorted([(1, 672, True, 1, None, 1), (1, 7157, True, 2, None, 1), (2, 672, False, None, 1, None), (3, 5728, True, 3, None, 2), (3, 1956, True, 4, None, 2), (3, 4609, True, 5, None, 3)], key=repr)
    with pytest.raises(DataContractError):
        S.id_list(text(spark, "12 x"))


def test_gff3_and_parents(spark, rows):
    lines = ["##gff", "c\ts\tgene\t1\t9\t.\t+\t.\tID=g1;Dbxref=GeneID:7,X:1;Note=a+b%20c", "c\ts\texon\t2\t5\t.\t+\t.\tID=x;Parent=m;Parent=z"]
    got = S.gff3(text(spark, *lines)).select("start", "attributes", S.gene_ids(F.col("attributes")).alias("g")).collect()
    assert got[0]["attributes"]["Note"] == "a+b c" and got[0]["g"] == ["7"] and got[1]["attributes"]["Parent"] == "m"
    with pytest.raises(DataContractError):
        S.gff3(text(spark, "a\tb"))
    tree = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("d", None)], "id string, parent string")
    assert rows(S.resolve_parents(tree)) == [("a", "a"), ("b", "a"), ("c", "a"), ("d", "d")]
    for bad in ([("a", "b"), ("b", "a")], [("a", "q")]):
        with pytest.raises(DataContractError):
            S.resolve_parents(spark.createDataFrame(bad, "id string, parent string"))


def test_vcf_rejects_short_records(spark, rows):
    assert rows(S.vcf(text(spark, "#h", "1\t100\t.\tA\tG\t.\t.\tCLNSIG=Benign")), "chrom", "pos", "info") == [("1", 100, "CLNSIG=Benign")]
    with pytest.raises(DataContractError):
        S.vcf(text(spark, "1\t100\t."))


def test_fasta_and_headers(spark, tmp_path, rows):
    (tmp_path / "a.fa").write_text(">NC_1.1:c20-11 gene [organism=Homo sapiens] [GeneID=7] [chromosome=X]\nacg\nT\n>two\nNN\n")
    df = S.fasta(spark, str(tmp_path / "a.fa"))
    assert rows(df, "sequence", "length") == [("ACGT", 4), ("NN", 2)]
    h = df.where("length = 4").select(S.header_fields("header").alias("h")).first()["h"]
    assert tuple(h) == ("NC_1.1", True, 11, 20, "7", "Homo sapiens", "X")


def test_fasta_slices_tile_their_files(spark, tmp_path):
    want = []
    for name, before, close in (("a", "", "\n"), ("b", "\n", ""), ("c", "junk\n", "\n")):
        body = before
        for k in range(40):
            start, letters = len(body.encode()), ["ACGTn" * (k % 9), "AC" * (k % 5)]
            body += f">{name}{k} \u00fc" + ("\r\n" if k % 7 == 0 else "\n") + "\n".join(letters) + (close if k == 39 else "\n")
            want.append((f"{name}.fa", k + 1, f"{name}{k} \u00fc", sum(map(len, letters)), start, len(body.encode())))
        (tmp_path / f"{name}.fa").write_bytes(body.encode())
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for split in ("500", size):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            assert sorted((r[0].rsplit("/", 1)[1], *r[1:]) for r in S.fasta_slices(spark, str(tmp_path)).collect()) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_parents_in_long_chains(spark):
    chain = spark.createDataFrame([(f"{k:03}", f"{k - 1:03}" if k else None) for k in range(200)], "id string, parent string")
    assert {r["root"] for r in S.resolve_parents(chain).collect()} == {"000"}
    with pytest.raises(DataContractError):
        S.resolve_parents(spark.createDataFrame([("a", "a")], "id string, parent string"))


def test_alignment_lines(spark, rows):
    line = "q\t10\t0\t10\t+\tt\t100\t5\t15\t9\t10\t60\tcs:Z::3*ag+tt-c:2"
    paf = S.paf(text(spark, line, line))
    assert len({r["record_id"] for r in paf.collect()}) == 2
    ev = Q.difference_events(paf.limit(1).withColumn("cs", F.col("tags")["cs"]), "cs", "target_start")
    assert rows(ev, "event_type", "start0", "end0", "ref", "alt") == [("del", 9, 10, "C", ""), ("ins", 9, 9, "", "TT"), ("snv", 8, 9, "A", "G")]
    sam = S.sam(text(spark, "@x", "q\t16\tt\t6\t60\t2S3M1D2M2N4M\t*\t0\t0\tA\tB\tNM:i:2"))
    assert rows(Q.cigar_segments(sam, "cigar", "start0"), "segment_start0", "segment_end0") == [(13, 17), (5, 8), (9, 11)]
    assert sam.first()["mismatches"] == 2


def test_text_tables_keep_empty_text_and_check_headers(spark, tmp_path, rows):
    (tmp_path / "a.tsv").write_text('a\tb\n1\t\n"x\tNA\n')
    (tmp_path / "b.tsv").write_text("b\ta\n1\t2\n")
    df = T.text_table(spark, str(tmp_path / "a.tsv"), ["a", "b"])
    assert rows(df) == [('"x', "NA"), ("1", "")]
    assert rows(T.text_table(spark, str(tmp_path / "a.tsv"), empty_as_null=True)) == [('"x', "NA"), ("1", None)]
    with pytest.raises(DataContractError):
        T.text_table(spark, [str(tmp_path / "a.tsv"), str(tmp_path / "b.tsv")], ["a", "b"])


def test_manifest_dataset(spark, tmp_path, rows):
    spark.createDataFrame([(1, "x"), (2, "y")], "k long, v string").write.parquet(str(tmp_path / "p1"))
    spec = {"format": "parquet", "columns": ["k", "v"], "partitions": [{"partition_id": "p1", "path": "p1", "rows": 2}]}
    (tmp_path / "m.json").write_text(json.dumps(spec, indent=1))
    assert rows(T.dataset(spark, str(tmp_path / "m.json"))) == [(1, "x", "p1"), (2, "y", "p1")]
    spec["partitions"][0]["rows"] = 3
    (tmp_path / "m2.json").write_text(json.dumps(spec))
    with pytest.raises(DataContractError):
        T.dataset(spark, str(tmp_path / "m2.json"))


def test_sinks(spark, tmp_path, rows):
    df = spark.createDataFrame([(k, k % 3, f"v{k}") for k in range(20)], "k long, tile long, v string")
    assert rows(T.write_partitioned(df, str(tmp_path / "p"), ["tile"]), "k", "tile", "v") == rows(df)
    assert T.write_checked(df, str(tmp_path / "c"), 20).count() == 20
    with pytest.raises(DataContractError):
        T.write_checked(df, str(tmp_path / "c"), 21)
    T.write_shards(df, str(tmp_path / "s"), ["k"], 3)
    sizes = spark.read.parquet(str(tmp_path / "s")).groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in sizes) <= 3
    T.write_text(df, str(tmp_path / "t"), ["k"])
    assert T.text_table(spark, str(tmp_path / "t")).count() == 20
    assert [T.append_fragments(d, str(tmp_path / "f"), ["k"], "tile") for d in (df.limit(5), df.limit(5), df)] == [5, 0, 15]


def test_repair_and_union(spark, rows):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    new = spark.createDataFrame([(1, "A"), (2, "B")], "k long, v string")
    assert rows(T.repaired(base, new, ["k"], ["v"], F.col("k") == 2)) == [(1, "a"), (2, "B")]
    with pytest.raises(DataContractError):
        T.union_exact(base, base.select("v", "k"))


SEQUENCE = "GATTTACAGGG"


@pytest.mark.parametrize(
    "event, want",
    [
        (("snv", "A", "G", 1), (101, "A", "G", "ok")),
        (("del", "T", "", 4), (101, "AT", "A", "ok")),
        (("ins", "", "G", 11), (107, "A", "AG", "ok")),
        (("snv", "C", "G", 1), (None, "C", "G", "ref_mismatch")),
        (("ins", "", "G", 0), (None, None, None, "missing_left_anchor")),
        (("snv", "N", "G", 1), (None, None, None, "non_concrete_allele")),
        (("dup", "A", "G", 1), (None, None, None, "unsupported_event_type")),
        (("snv", "A", "G", 40), (None, "A", "G", "out_of_target")),
    ],
)
def test_event_keys(spark, event, want):
    kind, ref, alt, at = event
    ev = spark.createDataFrame([("g", kind, ref, alt, "NC_000001.1", 1, at)], "gene_id string, event_type string, ref string, alt string, genomic_accession string, genomic_start1 long, target_start0 long")
    ctx = spark.createDataFrame([("g", 100, SEQUENCE)], "gene_id string, begin long, sequence string")
    r = Q.left_normalised(Q.anchored_events(ev, ctx)).first()
    assert (r["pos"], r["key_ref"], r["key_alt"], r["key_status"]) == want


def test_windows_end_with_the_sequence(spark, rows):
    df = spark.createDataFrame([("a", 25), ("b", 20), ("c", 4)], "k string, n long")
    assert rows(Q.windows(df, "n", 10, 10), "k", "window_start", "window_length") == [("a", 0, 10), ("a", 10, 10), ("a", 15, 10), ("b", 0, 10), ("b", 10, 10), ("c", 0, 4)]


def test_backbone(spark, rows):
    rng = random.Random(4)
    for _ in range(30):
        v = [rng.randrange(12) for _ in range(9)]
        chain = [v[i] for i in Q.increasing_backbone(v)]
        chosen = [[x for k, x in enumerate(v) if m >> k & 1] for m in range(512)]
        best = max(len(c) for c in chosen if all(a < b for a, b in zip(c, c[1:])))
        assert chain == sorted(set(chain)) and len(chain) == best
    df = spark.createDataFrame([("g", 0, 10, "+"), ("g", 5, 4, "+"), ("g", 8, 20, "+"), ("g", 9, 1, "-")], "g string, q long, t long, s string")
    assert rows(Q.backbone(df, ["g"], "q", "t", "s"), "q", "t") in ([(0, 10), (8, 20)], [(5, 4), (8, 20)])


def test_control_positions_are_seeded(spark, rows):
    focals = spark.createDataFrame([("g", f, "A") for f in range(3)], "gene string, focal long, base string")
    spans = spark.createDataFrame([("g", 10, 18, "ACGTAAAA"), ("g", 30, 34, "CACA")], "gene string, start long, end long, sequence string")
    a = rows(Q.control_positions(focals, spans, "gene", "focal", "base", 4))
    assert a == rows(Q.control_positions(focals.repartition(3), spans, "gene", "focal", "base", 4)) and len(a) == 12
    good = {10, 14, 15, 16, 17, 31, 33}
    assert all(p in good for *_, p in a)
    odd = spark.createDataFrame([("g", 1, None), ("g", 2, "T"), ("h", 3, "A")], "gene string, focal long, base string")
    assert rows(Q.control_positions(odd, spans, "gene", "focal", "base", 4)) == [("g", 2, 1, 13)]


def test_reads_and_tracks(spark, rows):
    p = spark.createDataFrame([("1", x) for x in (1, 3, 4, 50, 51, 300)], "axis string, pos long")
    assert rows(S.read_blocks(p, "axis", "pos", 100, 10), "start", "end", "positions") == [(1, 4, 3), (300, 300, 1), (50, 51, 2)]
    track = spark.createDataFrame([("1", 1, 3, 0.5)], "axis string, tile long, pos long, score double")
    assert rows(S.track_scores(p, track, "axis", "pos", "score", 25), "pos", "score")[-1] == (51, None)
