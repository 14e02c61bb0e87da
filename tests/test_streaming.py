from clonarium.operators.aggregates import best_score_per_variant
from clonarium.sources.headed import key_from_file_name
from clonarium.streaming.drops import append_new_files, appended


def test_only_new_files_are_read(spark, tmp_path, rows):
    drops = tmp_path / "drops"
    drops.mkdir()
    args = (
        spark, str(drops), str(tmp_path / "store"), "scores", key_from_file_name("{key}_scores.tsv"),
        {"pos": "bigint", "score": "double"}, str(tmp_path / "checkpoint"),
    )
    (drops / "A_scores.tsv").write_text("pos\tscore\n1\t0.5\n1\tNA\n")
    append_new_files(*args, markers=["NA", ""])
    append_new_files(*args, markers=["NA", ""])
    (drops / "B_scores.tsv").write_text("score\tother\tpos\n0.25\tx\t7\n")
    (drops / "B_notes.txt").write_text("pos\tscore\n9\t9\n")
    append_new_files(*args, markers=["NA", ""])
    table = appended(spark, str(tmp_path / "store"), "scores")
    assert rows(table) == [("A", 1, None), ("A", 1, 0.5), ("B", 7, 0.25)]
    best = best_score_per_variant(table.selectExpr("*", "'x' AS label"), ["entity", "pos"], "score", "label")
    assert rows(best) == [("A", 1, 0.5, "x"), ("B", 7, 0.25, "x")]
