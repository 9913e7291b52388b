import json

from inkstone import cli
from inkstone.functions.pinyin import with_pinyin
from inkstone.sources import storage


def test_pinyin(spark):
    df = spark.createDataFrame([("管仲",), ("赵盾",), ("夷吾",), ("",), (None,), ("Wen 公",)], "name string")
    got = {r["name"]: r["pinyin"] for r in with_pinyin(df, "name").collect()}
    assert got == {"管仲": "guanzhong", "赵盾": "zhaodun", "夷吾": "yiwu", "": "", None: None, "Wen 公": "wen gong"}


def test_verbs(spark, tmp_path, capsys):
    folder = str(tmp_path / "state")
    (tmp_path / "book.json").write_text(json.dumps({"title": "T", "chapters": [{"title": "a", "content": "晋晋\n齐"}, {"title": "b", "content": "晋"}]}))
    cli.main(["ingest", folder, str(tmp_path / "book.json"), "--corpus", "novel"])
    cli.main(["chunk", folder])
    cli.main(["discover", folder])
    assert capsys.readouterr().out == "sta:jin\t3\tnovel:1,novel:2\nsta:qi\t1\tnovel:1\n"
    cli.main(["export", folder, str(tmp_path / "out"), "v1", "documents", "chunks"])
    assert json.loads(capsys.readouterr().out)["counts"] == {"chunks": 2, "documents": 2}
    (tmp_path / "v.json").write_text("\n".join(json.dumps({"verdict": v}) for v in ("yes", "partial", "no", "yes")))
    cli.main(["qa-load", folder, str(tmp_path / "v.json")])
    assert json.loads(capsys.readouterr().out)["mismatch"] == 0.375


def test_link_skips_merged_siblings(spark, tmp_path):
    """Three of one name: the first is merged into the second, which then has no action of its own; the third is into the first."""
    folder = str(tmp_path / "state")
    people = "id string, run string, canonical_name string, variants array<string>, state_id string, clan_name string, social_category string, birth_bce int, death_bce int"
    rows = [(i, "r", "重耳", [], "sta:jin", "ji", None, None, None) for i in ("p1", "p2", "p3")]
    spark.createDataFrame(rows, people).write.parquet(f"{folder}/candidate_persons.parquet")
    spark.createDataFrame([], people).drop("run").write.parquet(f"{folder}/linkable_persons.parquet")
    for name in ("rejected_merges", "merge_candidates"):
        storage.empty(spark, name).write.parquet(f"{folder}/{name}.parquet")
    cli.main(["link", folder])
    got = {r["cand"]: (r["target"], r["action"]) for r in spark.read.parquet(f"{folder}/link_actions.parquet").collect()}
    assert got == {"p1": ("p2", "auto"), "p2": ("p1", "skip"), "p3": ("p1", "auto")}
