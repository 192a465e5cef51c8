import duckdb
from pyspark.sql import functions as F

from canvass.llm import chat_format as C
from canvass.llm.catalog import ORACLE_SQL, QUERIES

TESTDATA = "/root/testdata/sf0.001"
MSG = "tree long, id long, parent long, role string, text string, score double"
CONV = "conv_id long, turn long, role string, text string"


def test_query_equals_oracle(spark):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{TESTDATA}/conversations.parquet'")
    want = sorted(con.execute(ORACLE_SQL["op2_chat_format"]).fetchall())
    got = sorted(tuple(r) for r in QUERIES["op2_chat_format"](spark, TESTDATA).collect())
    assert got == want


def brute_paths(rows):
    """Best root-to-leaf path per tree, by definition."""
    ids = {(t, i): (p, r or "", x or "", s or 0.0) for t, i, p, r, x, s in rows}
    parents = {(t, v[0]) for (t, _), v in ids.items() if (t, v[0]) in ids}
    best = {}
    for t, i in ids:
        if (t, i) in parents:
            continue
        path, cur = [], (t, i)
        while cur in ids and cur not in path:
            path.append(cur)
            cur = (t, ids[cur][0])
        if cur in path:
            continue
        score = sum(ids[c][3] for c in path) / len(path)
        key = (-score, -len(path), i)
        if t not in best or key < best[t][0]:
            best[t] = (key, [(ids[c][1], ids[c][2]) for c in path[::-1]])
    return {t: v[1] for t, v in best.items()}


def test_branches_against_brute_force(spark):
    import random

    rng = random.Random(8)
    rows = []
    for t in range(12):
        for i in range(rng.randint(1, 25)):
            parent = None if i == 0 else rng.randint(max(0, i - 4), i - 1)
            rows.append((t, i, parent, rng.choice(["user", "assistant", None]), rng.choice(["a<|b", "\\", "", None, "x\ny"]), rng.choice([None, 0.5, 1.0, 2.0])))
    rows += [(50, 1, 2, "user", "cycle", 1.0), (50, 2, 1, "user", "cycle", 1.0), (51, 9, 77, "user", "orphan", 1.0)]
    rows += [(52, i, i - 1 if i else None, "user", str(i), 1.0) for i in range(70)]
    df = spark.createDataFrame(rows + rows[:5], MSG).withColumn("t", F.lit("clash")).withColumn("leaf", F.lit(0))
    out = C.format_conversations(df).withColumn("turns", C.read_turns(F.col("formatted"))).collect()
    got = {r.tree: [(x.role, x.text) for x in r.turns] for r in out}
    assert got == brute_paths(rows)
    for r in out:
        masked = [r.formatted[s.start : s.stop] for s in r.loss_spans]
        assert len(masked) == sum(x.role == "assistant" for x in r.turns)
    assert C.format_conversations(spark.createDataFrame([], MSG)).count() == 0


def test_second_branch(spark):
    rows = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "good", 5.0), (1, 3, 1, "assistant", "bad", 1.0)]
    out = C.format_conversations(spark.createDataFrame(rows, MSG), branches=2).orderBy("leaf").collect()
    assert [r.leaf for r in out] == [2, 3] and all("q" in r.formatted for r in out)


def test_escape_round_trip_and_odd_rows(spark):
    odd = ["<|", "<\\|", "\\", "\\\\<|", "<\\\\|end|>", "</s>[INST]", "[\\INST]", "<|turn|>x<|text|>", "", None, "<<s>", "[[/INST]", "é😀<|"]
    rows = [(1, i, "assistant" if i % 2 else o, o) for i, o in enumerate(odd)] + [(2, None, None, None), (2, None, None, None), (None, 1, "user", "n")]
    out = {r.conv_id: r for r in C.conversation_digests(C.format_conversations(C.conversation_messages(spark.createDataFrame(rows, CONV)))).collect()}
    assert out[1].n_turns == len(odd) and out[2].n_turns == 2 and out[None].n_turns == 1
    import hashlib

    said = "".join(f"{'assistant' if i % 2 else (o or '')}\n{o or ''}\n" for i, o in enumerate(odd))
    assert out[1].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
    loss = "".join(o or "" for i, o in enumerate(odd) if i % 2)
    assert out[1].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest() and out[1].loss_chars == len(loss)
    both = spark.createDataFrame([(o,) for o in odd if o is not None], "s string")
    for r in both.select("s", C.escape(F.col("s")).alias("e"), C.unescape(C.escape(F.col("s"))).alias("u")).collect():
        assert r.u == r.s and not any(c in r.e for c in C.CONTROL)
