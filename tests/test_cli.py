from evidra import cli
from evidra.operators import store

LONG = "0 (5s):\nAnna Smith sold 300 houses in 2019 to the city of Bonn. She was glad.\n\n1 (9s):\nYes, Anna Smith sold 300 houses in 2019 to the city of Bonn and more."


def test_process_skips_what_has_claims(spark, tmp_path):
    path = f"file://{tmp_path}"
    rows = [(1, 7, "2024-01-02", LONG), (2, 7, "2024-01-01", LONG), (3, 8, "2024-01-01", None), (4, 8, "2024-01-03", "0 (5s):\nno."), (5, 7, "2024-01-05", " ")]
    spark.createDataFrame(rows, "episode_id long, podcast_id long, air_date string, text string").write.parquet(f"{path}/e")
    spark.createDataFrame([(2,)], "episode_id long").write.parquet(f"{path}/c")
    got = {r.status: r.n for r in cli.main(["process", f"{path}/e", f"{path}/out", "--claims", f"{path}/c"]).collect()}
    assert got == {"ok": 1, "skipped": 1, "failed": 1}
    assert {r.episode_id for r in store.current(spark, f"{path}/out", "claims").collect()} == {1}
    got = {r.status: r.n for r in cli.main(["process", f"{path}/e", f"{path}/out", "--short", "--force", "--podcast", "7", "--latest", "2", "--dry-run"]).collect()}
    assert got == {"ok": 1, "failed": 1}


def test_validate_and_its_dry_run(spark, tmp_path):
    path = f"file://{tmp_path}"
    rows = [(1, i, "He said it was really great", False, False) for i in range(5)] + [(1, 9, "Revenue rose to 3 billion dollars", False, False), (2, 20, "He said so", False, False)]
    spark.createDataFrame(rows, "episode_id long, claim_id long, claim string, is_flagged boolean, is_verified boolean").write.parquet(f"{path}/c")
    assert cli.main(["validate", f"{path}/c", f"{path}/out", "--dry-run"]).first().n == 5
    assert {r.is_flagged: r.n for r in cli.main(["validate", f"{path}/c", f"{path}/out"]).collect()} == {True: 5, False: 1}
    after = {r.claim_id: (r.is_flagged, r.is_verified) for r in store.current(spark, f"{path}/out", "claims").collect()}
    assert after[0] == (True, True) and after[9] == (False, True) and after[20] == (False, False)
