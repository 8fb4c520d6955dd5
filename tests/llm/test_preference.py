from marginflow.llm import preference as pf
from marginflow.llm import queries


def rows():
    return [
        (1, 0, "user", "hi", 0), (1, 1, "assistant", "a", 0), (2, 0, "user", "hi", 0), (2, 1, "assistant", "b", 0), (2, 2, "user", "c", 0), (3, 0, "user", "hi", 0),
        (3, 1, "assistant", "b", 0), (3, 2, "user", "c", 0), (4, 0, "system", "s<|im_end|>", 0), (4, 1, "assistant", "x", 0), (4, 2, "user", None, 0), (4, 3, "assistant", "y", 0),
        (4, 3, "assistant", "y", 0), (None, 0, "user", "hi", 0), (None, 0, None, "hi", 0), (300, 0, "user", "hi", 0),
    ]


def test_prefix_masks_and_pairs(spark):
    turns = spark.createDataFrame(rows(), "conv_id long, turn long, role string, text string, first int")
    out = pf.flat(pf.format_pairs(pf.pairs_of(pf.conversations_of(turns))))
    got = {r.chosen_id: r for r in out.collect() if r.chosen_id is not None}
    assert out.count() == 7
    u = "<|im_start|>user\nhi<|im_end|>\n"
    assert got[1].rejected_id == 2 and got[1].n_shared == 1 and got[1].prompt == u
    assert got[1].chosen == "<|im_start|>assistant\na<|im_end|>\n" and got[1].chosen_mask == "0:22,1:11,0:1"
    assert got[1].rejected_mask == "0:22,1:11,0:1,0:17,0:11,0:1"
    assert got[2].rejected_id == 3 and got[2].tie and got[2].chosen == got[2].rejected == ""
    assert got[3].rejected_id == 300 and got[3].n_shared == 1 and not got[3].tie and got[3].rejected == ""
    assert got[3].chosen == "<|im_start|>assistant\nb<|im_end|>\n<|im_start|>user\nc<|im_end|>\n"
    assert got[4].n_shared == 3 and got[4].prompt.startswith("<|im_start|>system\ns<| im_end|><|im_end|>\n") and "x<|im_end|>" in got[4].rejected
    assert got[300].rejected_id is None and got[300].tie


def test_sql_agrees_where_pairs_are_real(spark, tmp_path):
    """Shared first turns, ids far apart, one first turn in a third of the conversations: code and SQL
    pair alike, and most conversations have a real rejected one."""
    import duckdb

    ids = [7, 255, 256, 300, 70_000, 10**12, *range(1_000, 90_000, 991)]
    rows = []
    for n, i in enumerate(ids):
        rows.append((i, 0, "user", "hot" if n % 3 == 0 else f"q{n % 9}"))
        rows += [(i, 1 + k, ("assistant", "user")[k % 2], f"t{(i + k) % 4}") for k in range(n % 5)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op7_preference(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    rel = con.sql(queries.ORACLE_SQL["op7_preference"])
    assert sorted(map(str, (tuple(r) for r in got.select(*rel.columns).collect()))) == sorted(map(str, rel.fetchall()))
    assert got.filter("rejected_id is not null").count() == len(ids) - 7  # seven first turns


def test_mask_covers_the_completion(spark):
    for r in queries.op7_preference(spark, "/root/testdata/sf0.001").collect():
        for text, mask in ((r.chosen, r.chosen_mask), (r.rejected, r.rejected_mask)):
            at = 0
            for run in mask.split(",") if mask else []:
                trained, n = map(int, run.split(":"))
                if trained:
                    assert text[:at].endswith("<|im_start|>assistant\n") and text[at : at + n].endswith("<|im_end|>")
                at += n
            assert at == len(text)


def test_empty_table(spark):
    t = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert pf.format_pairs(pf.pairs_of(pf.conversations_of(t))).collect() == []


def test_next_by_id_however_ids_are_numbered(spark):
    """Sparse and widely spread ids: each is chosen over the true next one of its first turn."""
    ids = [3, 255, 256, 300, 70_000, 10**12, -5, *range(1_000, 200_000, 997)]
    rows = [(i, k, r, t) for i in ids for k, r, t in ((0, "user", f"q{i % 2}" if i % 5 else "hot"), (1, "assistant", f"a{i}"))] + [(None, 0, "user", "hot")]
    got = pf.pairs_of(pf.conversations_of(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()
    want, first = {}, {i: f"q{i % 2}" if i % 5 else "hot" for i in ids}
    for f in set(first.values()):
        same = sorted(i for i in ids if first[i] == f)
        want |= dict(zip(same, [*same[1:], None], strict=True))
    assert len(got) == len(ids) + 1 and {r.chosen_id: r.rejected_id for r in got} == want | {None: None}
    assert all(r.rejected[1].text == f"a{r.rejected_id}" for r in got if r.rejected_id is not None)
