"""Builds from small source files in the formats of the cohort release."""

import bz2
import gzip
import hashlib
import json
import random
from urllib.parse import unquote

import pytest

from clonarium.operators import joins
from clonarium.operators.quality import CheckFailed
from clonarium.plans import build, tables
from clonarium.plans.build import Sources, build_store, check_store
from clonarium.plans.contracts import CONTRACTS, type_mismatches
from clonarium.sources import delimited, digests, headed
from clonarium.sources import store as stores
from clonarium.sources.store import current_root, read_table, source_provenance, write_table
from testdata_queries import files, jobs
from testdata_queries.registry import Tables

MUTATIONS = """patient_id\tpatient_tumour\ttumour_id\tsample_name_hash\tmutation_id\tchr\tstart\tstop\tpos\tref\tvar\tvar_count\tcov\tvaf\tis_present\tmutation_cluster
LTX0001\tLTX0001_tumour1\t1\tLTX0001_SU_T1-R1--aa\tLTX0001_1:17:100:G:T\tchr17\t100\t100\t100\tG\tT\t5\t20\t0.25\tTrue\t1.0
LTX0001\tLTX0001_tumour1\t1\tLTX0001_SU_T1-R2--bb\tLTX0001_1:17:100:G:T\tchr17\t100\t100\t100\tG\tT\t0\t30\t0\tFalse\t1
LTX0001\tLTX0001_tumour1\t1\tLTX0001_SU_T1-R1--aa\tLTX0001_1:M:41:A:-\tM\t42\t42\t41\tA\t-\t3\t10\t0.3\tTrue\tNA
LTX0008\tLTX0008_tumour2\t2\tLTX0008_SU_T2-R1--cc\tLTX0008_2:X:7:C:A\tX\t7\t7\t7\tC\tA\tNA\tNA\tNA\tTrue\t
"""
TREE = """tumour_id\tclone\tparent\tnumber_of_gds_at_clone\ttotal_gds_per_tumour\tquality\tstatus\tclass\tsub_class
LTX0001-Tumour1\tclone1\tdiploid\t0\t1\tHigh\tresolved\tmut_supported\tsingle subclonal GD
LTX0001-Tumour1\tclone2\tclone1\t1\t1\tHigh\tresolved\tmut_supported\tsingle subclonal GD
LTX0008-Tumour2\tclone1\tdiploid\tnan\t0\tLow\tunresolved\t\t
"""
DRIVERS = """Hugo_Symbol\tgene_id\tdriver_gene\tCGC_TIER\tmut_driver\tlung_mut_driver\tCN_driver\tlung_CN_driver\tchr_hg38\tstart_hg38\tchr_hg19\tstart_hg19
TP53\tENSG1\tTRUE\t1\tTRUE\tTRUE\tFALSE\tFALSE\tchr17\t10\tchr17\t11
ABC\tENSG2\tFALSE\tNA\tfalse\tNA\tmaybe\tFALSE\tchrX\t20\tX\t21
"""
COPY_NUMBER = """tumour_id,segment,clone,pred_CN_A,pred_CN_B
LTX0001-Tumour1,17_50_150,clone1,1,1
LTX0001-Tumour1,17_50_150,clone2,0,2
LTX0001-Tumour1,chrX_1_9,clone1,0,0
"""
CLINICAL = """Patient_ID\tage\tsex\thistology1_central.reviewed\thistology2_central.reviewed\tSizePath_lesion1_central.reviewed
LTX0001\t61\tMale\tLUAD\tNA\t12.5
LTX0008\tNA\tFemale\tLUAD\tLUSC\tNA
"""
FLAGS = """tumour_id\tmutation_cluster\ttreeClones\tseedingClones\tclonalClones\tsharedClones\tprimaryClones\tmetClones
LTX0001_1\t1\tTRUE\tFALSE\tTRUE\tFALSE\tTRUE\tFALSE
LTX0001_1\t2\tFALSE\tT\t0\tmaybe\tNA\tFALSE
CRUK0192_1\t1\tTRUE\tTRUE\tTRUE\tFALSE\tTRUE\tTRUE
"""
SEEDING = """tumour_id seedingClonality seedingPhyletic individualSeedingClonality individualSeedingPhyletic nRegions
LTX0001_1 monoclonal monophyletic monoclonal;monoclonal monophyletic;polyphyletic 2
LTX0008_1 polyclonal monophyletic polyclonal monophyletic 1
"""
CROSSWALK = "PatientID,CRUK_ID\nLTX0001,CRUK0001\n LTX0008 ,CRUK0192\n"


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("release")

    def put(name, text, zipped=False):
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(gzip.compress(text.encode()) if zipped else text.encode())
        return str(path)

    # column order differs between the two score files, a third file is not one
    put("scores/LTX0001_tumour1_muttable_alpha.tsv",
        "patient_id\tchr\tpos\tvar\talpha_missense\tam_class\n"
        "LTX0001\tchr17\t100\tT\t0.9\tLikely pathogenic\n"
        "LTX0001\tchr17\t100\tT\tnan\tNA\n"
        "LTX0001\tM\t41\t-\tNA\tnot_classified\n")
    put("scores/LTX0008_Tumour02_muttable_alpha.tsv",
        "am_class\talpha_missense\tvar\tgene\tpos\tchr\nambiguous\t0.4\tA\tG\t7\tX\n")
    put("scores/notes.tsv", "chr\tpos\n1\t2\n")
    put("cp/LTX0001-Tumour1/cp_table.csv", '"LTX0001_SU_T1-R1--aa",LTX0001_SU_T1-R2--bb,clone\r\n1,0.25,clone1\r\n0,0.75,"clone2"\r\n')
    put("cp/LTX0008-Tumour2/cp_table.csv", "clone,LTX0008_SU_T2-R1--cc\n\nclone1,NA\n")
    put("cp/LTX0009-Tumour1/cp_table.csv", "s1,s2\n1,2\n")
    put("cp/LTX0010-Tumour1/cp_table.csv", "s1,clone\nabc,clone1\n1,clone2\n")
    put("cp/LTX0011-Tumour1/cp_table.csv", "")
    put("cp/LTX0012-Tumour1/cp_table.csv", "s1,clone\n1,clone1,7\n")
    spark.createDataFrame(
        [("g1", 1.0, 2.0), ("g2", 3.0, 4.0)],
        "gene_id string, `LTX0001_SU_T1-R1--aa` double, `LTX0001_SU_N01--dd` double",
    ).write.parquet(str(root / "counts.parquet"))
    spark.createDataFrame(
        [("g1", 0.5, 1.5), ("g2", 1.0, 0.0)],
        "gene_id string, `LTX0001_SU_T1-R1--aa` double, `LTX0001_SU_N01--dd` double",
    ).write.parquet(str(root / "tpm.parquet"))
    gene = "0\tNM\t{chrom}\t{strand}\t{s}\t{e}\t0\t0\t1\t1,\t2,\t0\t{name}\tcmpl\tcmpl\t0,\n"
    genes = "".join(
        gene.format(chrom=c, strand=s, s=a, e=b, name=n)
        for c, s, a, b, n in [("chr17", "-", 90, 120, "TP53"), ("chr17", "+", 80, 110, "TP53"),
                              ("chrM", "+", 1, 5, "MT1"), ("chr6_hap", "+", 1, 2, "HLA")]
    )
    bundle = {
        "sample_id": "LTX0001_1", "regions": ["LTX0001_SU_T1.R1..aa"], "clones": ["1", "clone2"],
        "ccf": [[100], [30]], "clonality": [["clonal"], ["absent"]],
    }
    lines = [bundle, {**bundle, "sample_id": None}, {**bundle, "sample_id": "LTX0008_1", "ccf": None}]
    return Sources(
        crosswalk=put("key.csv", CROSSWALK),
        mutations=put("mutations.tsv.gz", MUTATIONS, zipped=True),
        clone_tree=put("tree.tsv", TREE),
        variant_scores=str(root / "scores/*.tsv"),
        clinical=put("clinical.tsv", CLINICAL),
        drivers=put("drivers.tsv", DRIVERS),
        copy_number=put("cn.csv", COPY_NUMBER),
        expression_counts=str(root / "counts.parquet"),
        expression_tpm=str(root / "tpm.parquet"),
        clone_proportions=str(root / "cp/*/cp_table.csv"),
        clone_flags=put("flags.txt", FLAGS),
        seeding=put("seeding.txt", SEEDING),
        genes=put("genes.txt.gz", genes, zipped=True),
        bands=put("bands.txt.gz", "chr17\t0\t85\tp13\tgneg\nchr17\t85\t300\tp12\tgpos\nchr17\t120\t200\tq1\tx\n", zipped=True),
        bundles=put("bundles.json", "\n".join(json.dumps(x) for x in lines)),
    )


@pytest.fixture(scope="module")
def store(spark, sources, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("store"))
    manifest = build_store(spark, sources, path, source_root="release", mode="sandbox", gzip_partitions=2)
    return path, {r.table: r.n_rows for r in manifest.collect()}


def test_manifest(store):
    assert store[1] == {
        "id_crosswalk": 2, "mutations": 4, "clone_tree": 3, "variant_scores": 3, "clinical": 2,
        "clinical_per_tumour": 3, "drivers": 2, "copy_number": 3, "expression": 4, "paired_normals": 2,
        "clone_proportions": 5, "clone_flags": 3, "seeding": 2, "gene_reference": 2, "region_ccf": 2,
        "region_clonality": 2,
    }


def test_types_follow_the_contracts(spark, store):
    for name in store[1]:
        assert type_mismatches(read_table(spark, store[0], name), CONTRACTS[name]) == [], name


def test_mutations(spark, store, rows):
    df = read_table(spark, store[0], "mutations")
    assert not {"patient_tumour", "mutation_cluster", "var"} & set(df.columns)
    assert rows(df, "tumour_id", "tumour_ordinal", "var_count") == [
        ("LTX0001-Tumour1", 1, 0), ("LTX0001-Tumour1", 1, 3), ("LTX0001-Tumour1", 1, 5),
        ("LTX0008-Tumour2", 2, None),
    ]
    assert {(r.tumour_id, r.chr, r.alt, r.clone) for r in df.collect()} == {
        ("LTX0001-Tumour1", "17", "T", "clone1"),
        ("LTX0001-Tumour1", "MT", "-", None),
        ("LTX0008-Tumour2", "X", "A", None),
    }


def test_tree(spark, store, rows):
    df = read_table(spark, store[0], "clone_tree")
    assert rows(df, "tumour_id", "clone", "is_root", "is_wgd_event_clone", "cumulative_gds_to_clone", "has_wgd_ancestor", "class") == [
        ("LTX0001-Tumour1", "clone1", True, False, 0, False, "mut_supported"),
        ("LTX0001-Tumour1", "clone2", False, True, 1, True, "mut_supported"),
        ("LTX0008-Tumour2", "clone1", True, None, 0, False, None),
    ]


def test_scores(spark, store, rows):
    assert rows(read_table(spark, store[0], "variant_scores")) == [
        ("LTX0001-Tumour1", "17", 100, "T", 0.9, "pathogenic"),
        # the score files use "-" as a null marker, so a deleted allele is null
        ("LTX0001-Tumour1", "MT", 41, None, None, None),
        ("LTX0008-Tumour2", "X", 7, "A", 0.4, "ambiguous"),
    ]


def test_drivers_and_copy_number(spark, store, rows):
    drivers = read_table(spark, store[0], "drivers")
    assert rows(drivers, "Hugo_Symbol", "CGC_TIER", "mut_driver", "lung_mut_driver", "CN_driver", "chr_hg38", "chr_hg19") == [
        ("ABC", None, False, None, None, "X", "X"), ("TP53", 1, True, True, False, "17", "17"),
    ]
    cn = read_table(spark, store[0], "copy_number")
    assert rows(cn, "segment_chr", "segment_start", "segment_end", "clone", "total_cn", "minor_cn", "is_homdel", "is_loh") == [
        ("17", 50, 150, "clone1", 2, 1, False, False),
        ("17", 50, 150, "clone2", 2, 0, False, True),
        ("X", 1, 9, "clone1", 0, 0, True, False),
    ]


def test_proportions_and_rejects(spark, store, rows):
    assert rows(read_table(spark, store[0], "clone_proportions")) == [
        ("LTX0001-Tumour1", "clone1", "LTX0001_SU_T1-R1--aa", 1.0),
        ("LTX0001-Tumour1", "clone1", "LTX0001_SU_T1-R2--bb", 0.25),
        ("LTX0001-Tumour1", "clone2", "LTX0001_SU_T1-R1--aa", 0.0),
        ("LTX0001-Tumour1", "clone2", "LTX0001_SU_T1-R2--bb", 0.75),
        ("LTX0008-Tumour2", "clone1", "LTX0008_SU_T2-R1--cc", None),
    ]
    rejects = spark.read.parquet(f"{current_root(spark, store[0])}/_rejects/clone_proportions.parquet")
    assert {(r.path.split("/")[-2], r.reason) for r in rejects.collect()} == {
        ("LTX0009-Tumour1", "no column clone"),
        ("LTX0010-Tumour1", "cell is not a number"),
        ("LTX0012-Tumour1", "line longer than the header"),
    }


def test_flags_seeding_and_regions(spark, store, rows):
    flags = read_table(spark, store[0], "clone_flags")
    assert rows(flags, "tumour_id", "clone", "is_tree_clone", "is_seeding_clone", "is_clonal", "is_shared", "is_primary_clone") == [
        ("LTX0001-Tumour1", "clone1", True, False, True, False, True),
        ("LTX0001-Tumour1", "clone2", False, True, False, None, None),
        ("LTX0008-Tumour1", "clone1", True, True, True, False, True),
    ]
    assert rows(read_table(spark, store[0], "seeding"), "tumour_id", "n_regions") == [
        ("LTX0001-Tumour1", 2), ("LTX0008-Tumour1", 1),
    ]
    assert rows(read_table(spark, store[0], "region_ccf"), "tumour_id", "clone", "ccf") == [
        ("LTX0001-Tumour1", "clone1", 100), ("LTX0001-Tumour1", "clone2", 30),
    ]
    rejects = spark.read.parquet(f"{current_root(spark, store[0])}/_rejects/bundles.parquet")
    assert rows(rejects) == [(None, "no sample id"), ("LTX0008_1", "matrix missing")]


def test_genes(spark, store, rows):
    assert rows(read_table(spark, store[0], "gene_reference")) == [
        ("MT1", "MT", 1, 5, "+", ""), ("TP53", "17", 80, 120, "-", "p12;p13"),
    ]


def test_other_convention(spark, sources, store, rows):
    crosswalk = read_table(spark, store[0], "id_crosswalk")
    flags = tables.clone_flags(spark, sources.clone_flags, crosswalk, "cruk")
    assert rows(flags, "tumour_id", "clone") == [
        ("CRUK0001_1", "clone1"), ("CRUK0001_1", "clone2"), ("CRUK0192_1", "clone1"),
    ]


def test_failing_guards(spark, store, tmp_path):
    crosswalk = read_table(spark, store[0], "id_crosswalk")

    def path(text):
        f = tmp_path / f"f{len(list(tmp_path.iterdir()))}.txt"
        f.write_text(text)
        return str(f)

    with pytest.raises(CheckFailed, match="bad cruk_patient_id"):
        tables.id_crosswalk(spark, path("PatientID,CRUK_ID\nLTX1,CR1\n"))
    with pytest.raises(CheckFailed, match="ltx_patient_id has duplicates"):
        tables.id_crosswalk(spark, path("PatientID,CRUK_ID\nLTX1,CRUK1\nLTX1,CRUK2\n"))
    with pytest.raises(CheckFailed, match="metClones"):
        tables.clone_flags(spark, path(FLAGS.replace("metClones", "other")), crosswalk)
    with pytest.raises(CheckFailed, match="duplicate"):
        tables.clone_flags(spark, path(FLAGS + FLAGS.splitlines()[1] + "\n"), crosswalk)
    with pytest.raises(CheckFailed, match="list length"):
        tables.seeding(spark, path(SEEDING.replace("polyphyletic 2", "polyphyletic 3")), crosswalk)
    with pytest.raises(Exception, match="patient not in crosswalk"):
        tables.seeding(spark, path(SEEDING.replace("LTX0008", "LTX0009")), crosswalk, "cruk").collect()
    bad = {"sample_id": "LTX0001_1", "regions": ["R"], "clones": ["1"], "ccf": [[1]], "clonality": [["partly"]]}
    with pytest.raises(CheckFailed, match="unexpected values"):
        tables.region_tables(spark, path(json.dumps(bad)), crosswalk)


def test_store_check(spark, store):
    report = check_store(spark, store[0], ["mutations", "clone_tree", "copy_number", "clone_proportions"])
    bad = {(r.table, r.check): r.n_bad for r in report.collect() if r.n_bad}
    assert bad == {}


def test_provenance(spark, store, sources):
    saved = spark.read.parquet(f"{current_root(spark, store[0])}/_provenance.parquet")
    assert saved.where("length(digest) = 64").count() == saved.count() > 15
    assert saved.where("n_columns = 16 and path like '%mutations.tsv.gz'").count() == 1
    one = source_provenance(spark, sources.drivers).first()
    assert (one.n_bytes, one.digest) == (len(DRIVERS), hashlib.sha256(DRIVERS.encode()).hexdigest())
    lines = source_provenance(spark, sources.drivers, "lines")
    assert lines.columns == ["path", "n_bytes", "modified", "digest"]
    assert lines.first().digest.startswith("3:")
    with pytest.raises(ValueError):
        source_provenance(spark, sources.drivers, "md5")


def test_large_files_are_hashed_by_tasks_that_read_a_split_each(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stores, "WHOLE_BYTES", 1000, raising=False)
    noise = random.Random(5).randbytes(20_000)
    mark = b"\xef\xbb\xbf"
    contents = {
        "noise": noise, "ended": noise + b"\n", "two ends": noise + b"\n\n", "marked": mark + noise, "marked ended": mark + b"\n" + noise + b"\n",
        "marked twice": mark + mark + noise, "feeds": b"\n" * 10_000, "returns": b"a\r\nb\r" * 2_000 + b"\r\n",
        "no line [1-2]{a,b}*%20 é": noise.replace(b"\n", b""), "long lines": (b"x" * 9_000 + b"\n") * 3,
        "zeros": bytes(20_000), "just over": b"y" * 1001, "small": b"z" * 1000,
    }
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    spark.range(5000).write.parquet(f"{tmp_path}/table.parquet")
    contents |= {f.name: f.read_bytes() for f in tmp_path.glob("table.parquet/*.parquet")}
    small = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "4096", "spark.sql.sources.binaryFile.maxLength": "1000"}
    before = {name: str(spark.conf.get(name)) for name in small}
    try:
        for name, value in small.items():
            spark.conf.set(name, value)
        # Any larger file that one task takes whole now fails.
        found = source_provenance(spark, [str(tmp_path), f"{tmp_path}/table.parquet"]).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert len(found) == len(contents) >= 14
    wanted = {name: (len(content), hashlib.sha256(content).hexdigest()) for name, content in contents.items()}
    assert {unquote(r.path).rsplit("/", 1)[1]: (r.n_bytes, r.digest) for r in found} == wanted
    times = {f.name: f.stat().st_mtime for f in [*tmp_path.iterdir(), *tmp_path.glob("table.parquet/*")]}
    assert all(abs(r.modified.timestamp() - times[unquote(r.path).rsplit("/", 1)[1]]) < 1 for r in found)
    # A packed file is hashed as it lies there.
    (tmp_path / "packed [2].gz").write_bytes(gzip.compress(noise))
    [packed] = source_provenance(spark, f"{tmp_path}/packed*").collect()
    assert packed.digest == hashlib.sha256((tmp_path / "packed [2].gz").read_bytes()).hexdigest()


def test_tree_digest_knows_the_order_of_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stores, "RANGE_LINES", 100)
    lines = [f"line {i % 700} " + "x" * (i % 90) for i in range(2000)] + [""]
    (tmp_path / "a.txt").write_text("\n".join(lines))
    lines[1234], lines[1235] = lines[1235], lines[1234]
    (tmp_path / "b.txt").write_text("\n".join(lines))
    (tmp_path / "c.txt.gz").write_bytes(gzip.compress("\n".join(lines).encode()))

    def plain(rows):
        hashes = [hashlib.sha256(line.encode()).hexdigest().upper() for line in rows[:-1]]
        ranges = [hashlib.sha256("".join(hashes[i : i + 100]).encode()).hexdigest().upper() for i in range(0, len(hashes), 100)]
        return hashlib.sha256("".join(ranges).encode()).hexdigest()

    names = {n: str(spark.conf.get(n)) for n in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    found = []
    try:
        for size in ("4096", "1000000"):
            for name in names:
                spark.conf.set(name, size)
            saved = source_provenance(spark, str(tmp_path / "*"), "tree").collect()
            found.append({r.path.rsplit("/", 1)[1]: r.digest for r in saved})
            sums = {r.path.rsplit("/", 1)[1]: r.digest for r in source_provenance(spark, str(tmp_path / "*"), "lines").collect()}
    finally:
        for name, value in names.items():
            spark.conf.set(name, value)
    assert found[0] == found[1]
    assert found[0]["b.txt"] == found[0]["c.txt.gz"] == plain(lines)
    lines[1234], lines[1235] = lines[1235], lines[1234]
    assert found[0]["a.txt"] == plain(lines) != found[0]["b.txt"]
    assert sums["a.txt"] == sums["b.txt"]


def test_a_failed_build_leaves_the_store_as_it_was(spark, sources, tmp_path, monkeypatch):
    path, some = str(tmp_path / "store"), Sources(drivers=sources.drivers, crosswalk=sources.crosswalk)
    build_store(spark, some, path)
    before, root = read_table(spark, path, "drivers").count(), current_root(spark, path)
    reading = read_table(spark, path, "id_crosswalk")
    with monkeypatch.context() as patched:
        patched.setattr(tables, "drivers", lambda *args: (_ for _ in ()).throw(RuntimeError("half way")))
        with pytest.raises(RuntimeError, match="half way"):
            build_store(spark, some, path)
    assert current_root(spark, path) == root and read_table(spark, path, "drivers").count() == before
    assert len(list((tmp_path / "store" / "_versions").iterdir())) == 1
    # Readers of the version before the one in use still find it; older ones go.
    build_store(spark, Sources(drivers=sources.drivers), path)
    assert current_root(spark, path) != root and reading.count() == 2
    build_store(spark, Sources(drivers=sources.drivers), path)
    assert len(list((tmp_path / "store" / "_versions").iterdir())) == stores.KEPT_VERSIONS
    assert len([f for f in (tmp_path / "store" / "_published").iterdir() if not f.name.startswith(".")]) == stores.KEPT_VERSIONS
    # A table written straight into a folder is read from there.
    write_table(spark.range(3).toDF("k"), str(tmp_path / "plain"), "t", ["k"])
    assert read_table(spark, str(tmp_path / "plain"), "t").count() == 3


def test_write_table_sorts_by_key(spark, tmp_path):
    df = spark.range(1000).selectExpr("(id * 37) % 1000 AS k", "id AS v")
    path = write_table(df, str(tmp_path), "t", ["k"], files=3)
    files = sorted((tmp_path / "t.parquet").glob("*.parquet"))
    assert len(files) == 3 and all(".zstd." in f.name for f in files)
    ranges = [spark.read.parquet(str(f)).selectExpr("min(k)", "max(k)").first() for f in files]
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    assert spark.read.parquet(path).count() == 1000


def test_entity_files_need_their_columns(spark, tmp_path):
    (tmp_path / "A_x.tsv").write_text("a\tb\n1\t2\n")
    args = (spark, str(tmp_path / "*.tsv"), headed.key_from_file_name("{key}_x.tsv"))
    got = headed.read_entity_columns(*args, {"b": "int"}, markers=delimited.MARKERS_PLAIN)
    assert [tuple(r) for r in got.collect()] == [("A", 2)]
    with pytest.raises(Exception, match="columns c are missing"):
        headed.read_entity_columns(*args, {"c": "int"}, markers=[]).collect()
    none = headed.read_entity_columns(
        spark, str(tmp_path / "*.tsv"), headed.key_from_file_name("{key}_y.tsv"), {"b": "int"}, markers=[]
    )
    assert none.dtypes == [("entity", "string"), ("b", "int")] and none.count() == 0


def test_one_large_file_is_read_in_splits(spark, tmp_path):
    """The header is found although the file spans many tasks."""
    lines = ["s1,clone,s2"] + [f"{i},clone{i},{i * 2}" for i in range(5000)]
    (tmp_path / "T1").mkdir()
    (tmp_path / "T1" / "cp_table.csv").write_text("\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        path = str(tmp_path / "*/cp_table.csv")
        assert spark.read.text(path).rdd.getNumPartitions() > 5
        long, rejects = headed.read_ragged_matrices(spark, path, "clone", markers=[])
        got = long.selectExpr("count(*)", "count(DISTINCT clone)", "sum(value)", "max(column)", "max(entity)").first()
        assert tuple(got) == (10_000, 5000, sum(i * 3 for i in range(5000)), "s2", "T1")
        assert rejects.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_bad_cast_fails(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("x\ty\n1\tNA\nabc\t2\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        delimited.read_delimited(spark, str(tmp_path / "a.tsv"), {"x": "int"}).collect()
    with pytest.raises(CheckFailed, match="lacks columns"):
        delimited.read_delimited(spark, str(tmp_path / "a.tsv"), {"z": "int"})


def test_lines_of_another_size_fail(spark, tmp_path):
    for name, text in (("long", "x\ty\n1\t2\n3\t4\t99\n"), ("short", "x\ty\n1\t2\n3\n")):
        (tmp_path / f"{name}.tsv").write_text(text)
        for partitions in (None, 2):
            with pytest.raises(Exception, match="(?i)malformed"):
                delimited.read_delimited(spark, str(tmp_path / f"{name}.tsv"), {"x": "int"}, partitions=partitions).collect()


def test_spreading_lines_changes_no_row(spark, tmp_path, rows):
    text = 'x\ty\n\n1\t"a\tb"\nx\ty\n  \n2\tNA\n x\t y\n'
    (tmp_path / "a.tsv.gz").write_bytes(gzip.compress(text.encode()))
    (tmp_path / "b.tsv.gz").write_bytes(gzip.compress(b"x\ty\n9\tz\n"))
    got = [
        rows(delimited.read_delimited(spark, str(tmp_path / "*.gz"), {"x": "string", "y": "string"}, partitions=n))
        for n in (None, 1, 3)
    ]
    assert got[0] == got[1] == got[2]
    assert len(got[0]) == 5 and ("x", "y") in got[0] and ("1", "a\tb") in got[0]


def test_headed_files_keep_lines_like_their_header(spark, tmp_path, rows):
    (tmp_path / "A+1").mkdir()
    (tmp_path / "A+1" / "x.csv").write_text('a,b\n1,"2, ""3"""\na,b\n')
    got = headed.read_entity_columns(
        spark, str(tmp_path / "*/x.csv"), headed.key_from_directory(), {"b": "string"}, sep=",", markers=[]
    )
    assert rows(got) == [("A+1", '2, "3"'), ("A+1", "b")]
    (tmp_path / "A+1" / "x.csv").write_text("a,b\n1\n")
    with pytest.raises(Exception, match="line shorter than the header"):
        headed.read_entity_columns(spark, str(tmp_path / "*/x.csv"), headed.key_from_directory(), {"b": "int"}, sep=",", markers=[]).collect()


def test_session_settings_and_scratch_are_put_back(spark, sources, tmp_path):
    from clonarium.session import RUNTIME_SETTINGS, scratch_folder

    before = {k: spark.conf.get(k, None) for k in RUNTIME_SETTINGS}
    folder = scratch_folder(spark)
    manifest = build_store(spark, Sources(drivers=sources.drivers, crosswalk=sources.crosswalk), str(tmp_path / "s"))
    assert manifest.count() == 2
    assert {k: spark.conf.get(k, None) for k in RUNTIME_SETTINGS} == before
    assert scratch_folder(spark) == folder
    import pathlib

    assert not list(pathlib.Path(folder.removeprefix("file:")).glob("job-*"))


def test_every_customer_is_in_a_proportion_file(spark):
    class Given:
        def __init__(self):
            self.spark = spark
            self.customer = spark.range(50).selectExpr("id AS c_custkey", "int(id % 25) AS c_nationkey")

    rows = spark.read.text(jobs._proportion_files(Given())).where("value NOT LIKE '%shared%'")
    names = sorted(int(r.value.split(",")[0].removeprefix("clone")) for r in rows.collect())
    assert names == list(range(50))


def test_each_source_file_has_its_own_digest(spark, tmp_path):
    spark.range(10).write.parquet(f"{tmp_path}/one.parquet")
    spark.range(40).repartition(3).write.parquet(f"{tmp_path}/several.parquet")
    (tmp_path / "whole.parquet").write_bytes(b"one file")
    (tmp_path / "other.txt").write_text("not a table")
    parts = [f for f in tmp_path.rglob("*.parquet") if f.is_file()]
    wanted = {(str(f.relative_to(tmp_path)), f.stat().st_size, hashlib.sha256(f.read_bytes()).hexdigest()) for f in parts}
    found = files.source_files(Tables(spark, str(tmp_path))).collect()
    assert len(found) == len(parts) >= 5
    assert {tuple(r) for r in found} == wanted


def test_tables_of_large_files_have_their_provenance(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stores, "WHOLE_BYTES", 1000, raising=False)
    spark.range(5000).coalesce(1).write.parquet(f"{tmp_path}/large.parquet")
    (tmp_path / "small.parquet").write_bytes(b"one file")
    before = spark.conf.get("spark.sql.sources.binaryFile.maxLength")
    try:
        spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")
        found = files.source_provenance(Tables(spark, str(tmp_path))).collect()
    finally:
        spark.conf.set("spark.sql.sources.binaryFile.maxLength", str(before))
    assert sorted(map(tuple, found)) == [("large", 64, True), ("small", 64, True)]


def test_what_a_task_hashes_does_not_grow_with_the_file(spark, tmp_path, monkeypatch):
    taken_up, most = digests._taken_up, 8192

    def bounded(states):
        go_on = taken_up(states)

        def within(split, parts):
            for number, state in go_on(split, parts):
                assert state[1] - states[number][1] <= most
                yield number, state

        return within

    monkeypatch.setattr(stores, "WHOLE_BYTES", 1000)
    monkeypatch.setattr(digests, "_taken_up", bounded)
    contents = {name: random.Random(7).randbytes(n) for name, n in (("small", 12_000), ("large", 48_000))}
    for name, content in contents.items():
        (tmp_path / f"{name}.parquet").write_bytes(content)
    split = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "4096", "spark.sql.sources.binaryFile.maxLength": "1000"}
    before = {name: str(spark.conf.get(name)) for name in split}
    try:
        for name, value in split.items():
            spark.conf.set(name, value)
        found = files.source_provenance(Tables(spark, str(tmp_path))).collect()
        sums = files.source_files(Tables(spark, str(tmp_path))).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sorted(map(tuple, found)) == [("large", 64, True), ("small", 64, True)]
    wanted = {(f"{name}.parquet", len(content), hashlib.sha256(content).hexdigest()) for name, content in contents.items()}
    assert {tuple(r) for r in sums} == wanted


def test_packed_files_are_hashed_in_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stores, "WHOLE_BYTES", 1000)
    noise = random.Random(8).randbytes(20_000)
    contents = {
        "packed [2]{a}.gz": gzip.compress(noise), "PACKED.GZ": gzip.compress(noise), "packed.bz2": bz2.compress(noise), "no gzip.gz": noise + b"\n\n",
        "marked.gz": b"\xef\xbb\xbf" + noise, "feeds.deflate": b"\n" * 2000, "one line.gz": noise.replace(b"\n", b""), "small.gz": gzip.compress(b"a"), "plain": noise,
    }
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    small = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "4096", "spark.sql.sources.binaryFile.maxLength": "1000"}
    before = {name: str(spark.conf.get(name)) for name in small}
    try:
        for name, value in small.items():
            spark.conf.set(name, value)
        # A larger file that a task takes as a row now fails.
        found = source_provenance(spark, str(tmp_path)).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    wanted = {name: (len(content), hashlib.sha256(content).hexdigest()) for name, content in contents.items()}
    assert {unquote(r.path).rsplit("/", 1)[1]: (r.n_bytes, r.digest) for r in found} == wanted


def test_scores_are_read_by_file_and_reduced_without_a_sort(spark, tmp_path):
    """A file's columns are found once, not for each line; known labels are compared by place."""
    for name, text in {"LTX1_tumour1": "var\tchr\tpos\talpha_missense\tam_class\nA\tchr1\t5\t0.5\tLikely pathogenic\n"
                       "A\t1\t5\tNA\tambiguous\n", "LTX2_tumour01": "pos\tchr\tam_class\tvar\talpha_missense\n7\tM\todd\tT\t1\n"}.items():
        (tmp_path / f"{name}_muttable_alpha.tsv").write_text(text)
    (tmp_path / "other.tsv").write_text("x\n1\n")
    found = tables.variant_scores(spark, str(tmp_path / "*.tsv"))
    assert sorted(map(tuple, found.collect())) == [
        ("LTX1-Tumour1", "1", 5, "A", 0.5, "ambiguous"), ("LTX2-Tumour1", "MT", 7, "T", 1.0, None)
    ]
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert "SortAggregate" not in plan
    # The plan's steps come last first: columns are looked for below the join with the files.
    assert "array_except" in plan and plan.index("Join") < plan.index("array_except")


def test_a_computed_table_is_written_before_its_ranges_are_bounded(spark, sources, tmp_path, monkeypatch):
    """The bounds take a pass of their own, which must not compute the table."""
    plans, write = {}, build.write_table

    def recorded(df, store, table, key=()):
        plans[table] = df._jdf.queryExecution().optimizedPlan().toString()
        return write(df, store, table, key)

    monkeypatch.setattr(build, "write_table", recorded)
    build_store(spark, Sources(crosswalk=sources.crosswalk, drivers=sources.drivers), str(tmp_path / "store"))
    assert set(plans) == {"id_crosswalk", "drivers"}
    assert all(p.startswith("Relation") for p in plans.values())


def test_sample_names_are_taken_apart_once(spark, rows):
    counts = spark.createDataFrame([("G1", 1.0, 2.0, 3.0), ("G2", 4.0, 5.0, None)], "gene_id string, `LTX1_SU_T1-R2--0a` double, `LTX1_SU_N01--0b` double, `odd.name` double")
    found = joins.expression_from_matrices(counts, counts)
    assert rows(found, "sample_name_hash", "patient_id", "is_normal", "tumour_ordinal", "region_ordinal", "gene_id", "counts", "tpm") == [
        ("LTX1_SU_N01--0b", "LTX1", True, None, None, "G1", 2.0, 2.0), ("LTX1_SU_N01--0b", "LTX1", True, None, None, "G2", 5.0, 5.0),
        ("LTX1_SU_T1-R2--0a", "LTX1", False, 1, 2, "G1", 1.0, 1.0), ("LTX1_SU_T1-R2--0a", "LTX1", False, 1, 2, "G2", 4.0, 4.0),
        ("odd.name", None, None, None, None, "G1", 3.0, 3.0), ("odd.name", None, None, None, None, "G2", None, None),
    ]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" in plan and plan.index("Join Inner") < plan.index("RLIKE")


def test_a_bundle_id_is_translated_once(spark, rows, tmp_path, monkeypatch):
    crosswalk = spark.createDataFrame([("LTX7", "CRUK8")], "ltx_patient_id string, cruk_patient_id string")
    cells = {"regions": ["R1", "R2"], "clones": ["1"], "ccf": [[3, 4]], "clonality": [["clonal", "absent"]]}
    bundles = [{"sample_id": "CRUK8_1", **cells}, {"sample_id": "CRUK9_1", "regions": ["R"], "clones": [], "ccf": [], "clonality": []}]
    (tmp_path / "b.json").write_text("\n".join(map(json.dumps, bundles)))
    given, translate = [], tables.with_convention
    monkeypatch.setattr(tables, "with_convention", lambda df, *rest: given.append(df.columns) or translate(df, *rest))
    ccf, clonality, _ = tables.region_tables(spark, str(tmp_path / "b.json"), crosswalk)
    assert rows(ccf) == [("LTX7-Tumour1", "clone1", "R1", 3), ("LTX7-Tumour1", "clone1", "R2", 4)]
    assert rows(clonality, "tumour_id", "region", "clonality") == [("LTX7-Tumour1", "R1", "clonal"), ("LTX7-Tumour1", "R2", "absent")]
    assert len(given) == 1 and "ccf" in given[0]
    (tmp_path / "c.json").write_text(json.dumps({**bundles[0], "clones": None}))
    with pytest.raises(Exception, match="matrix without row or column names"):
        tables.region_tables(spark, str(tmp_path / "c.json"), crosswalk)
