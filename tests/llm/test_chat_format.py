import hashlib

from hypothesis import given
from hypothesis import strategies as st

from aeris.llm import chat_format as C

SF = "/root/testdata/sf0.001"
COLUMNS = "conv_id long, turn int, role string, text string"
pieces = st.lists(st.sampled_from(["\\", "#", "### ", "</turn>", "\n", " ", "a", "<", "/", "é", "assistant"]), max_size=8).map("".join)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system"]) | pieces, pieces), max_size=6))
def test_round_trip(turns):
    records = list(C.examples_of(turns))
    for place, text, a, b in records:
        upto = turns if place < 0 else turns[: place + 1]
        assert C.parse(text) == upto
        assert C.unescape(text[a:b]) == ("" if place < 0 else turns[place][1])
    assert [p for p, *_ in records if p >= 0] == [i for i, (r, _) in enumerate(turns) if r == "assistant"]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute(rows):
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    return {c: (len(t), sha("".join(f"{r}\n{x}\n" for r, x in t)), sum(len(x) for r, x in t if r == "assistant"),
                sha("".join(x for r, x in t if r == "assistant"))) for c, t in out.items()}


def read(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in C.read_back(C.expand(df)).collect()}


def test_edge_rows(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 2, "assistant", "a\\### b</turn>"), (1, 3, "user", None),
            (2, 5, "assistant", "x" * 300_000), (3, 1, "user", "only"), (4, None, None, None), (None, 0, "assistant", "n"),
            (5, 1, "user", "same"), (5, 1, "user", "same"), (5, 1, "assistant", "tie"), (6, 0, "assistant", "")]
    rows += [(9, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(300)]
    df = spark.createDataFrame(rows, COLUMNS).selectExpr("*", "'x' AS place", "'y' AS formatted", "1 AS whole").repartition(3)
    assert read(df) == brute(rows)


def formatted_chars(rows):
    own = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own.setdefault(conv, []).append((role, text))
    return {c: sum(len(x[1]) for x in C.examples_of(t)) for c, t in own.items()}


def test_hot_conversations_are_cut_into_blocks(spark):
    """A long conversation, the null one among them, is spread over tasks; texts, digests and characters are as if whole."""
    rows = [(c, i // 2, "user" if i % 3 else "assistant", f"{i} said ### </turn> \\ é") for c in (7, None) for i in range(600)]
    rows += [(8, None, "assistant", "same")] * 150 + [(9, 0, "user", "x" * 900), (9, 1, "assistant", "y" * 900), (9, 2, "user", None)]
    rows += [(c, t, r, f"{c} {t}") for c in range(20, 60) for t, r in enumerate(("user", "assistant", "user"))]
    df = spark.createDataFrame(rows, COLUMNS).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small ranges would be read by one task
    try:
        examples = C.expand(df, long_chars=1500, long_turns=40)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    held = examples.select("conv_id", "block", "place", "formatted", "whole", "context_chars", "last", "parted").collect()
    assert {r.conv_id for r in held if r.parted} == {7, None, 8, 9}
    assert all(r.context_chars == 0 and r.last and r.block == 0 for r in held if not r.parted)
    tasks = {r.block >> 32 for r in held if r.conv_id == 7}
    assert len(tasks) > 1 and max(len(C.parse(r.formatted)) for r in held if r.conv_id == 7) <= 40
    blocks = sorted((r.block, r.formatted) for r in held if r.conv_id == 7 and r.whole)
    for r in held:  # what context_chars refers to
        if r.conv_id == 7:
            assert r.context_chars == sum(len(t) for b, t in blocks if b < r.block) and r.last == (r.block == blocks[-1][0])
    got = C.read_back(examples).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == brute(rows)
    assert {r.conv_id: r.formatted_chars for r in got} == formatted_chars(rows) and len(got) == 44


def test_empty_table(spark):
    assert read(spark.createDataFrame([], COLUMNS)) == {}


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = C.op4_chat_format(spark, SF).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == brute(rows + C.PLANTED)
    assert {r.conv_id: r.formatted_chars for r in got} == formatted_chars(rows + C.PLANTED)
