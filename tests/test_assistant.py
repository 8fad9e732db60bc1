import random
import re

from packetloom.operators import assistant, federated
from packetloom.schemas import ALERTS, BLOCKED

PATTERN = re.compile(r"<think>(.*?)(?:</think>|$)", re.DOTALL)


#: Chunks of a reply as (response, thinking), with its answer and reasoning.
REPLIES = [
    ([("Hello", None), (" world", None)], ("Hello world", "")),
    ([("<think>why", None), (" so</think>", None), ("done", None)], ("done", "why so")),
    ([("<th", None), ("ink>cut", None), ("</think>x", None)], ("x", "cut")),
    ([("<think>never closed", None), (" at all", None)], ("", "never closed at all")),
    ([("", "step 1, "), ("", "step 2"), ("answer", "")], None),
    ([(None, "a"), ("kept", "b")], ("kept", "ab")),
    ([(None, None), ("", None)], ("", "")),
]


def chunk_table(spark, replies):
    rows = [(reply, i, *c) for reply, chunks in enumerate(replies) for i, c in enumerate(chunks)]
    random.Random(5).shuffle(rows)
    return spark.createDataFrame(rows, "reply int, seq int, response string, thinking string")


def test_chunks_of_known_replies(spark):
    got = {r.reply: (r.answer, r.reasoning) for r in assistant.assemble_chunks(chunk_table(spark, [c for c, _ in REPLIES]), "reply", "seq").collect()}
    for reply, (_, want) in enumerate(REPLIES):
        assert want is None or got[reply] == want


def test_blocks_change_no_reply(spark):
    rng = random.Random(7)
    pieces = ["a", "b\n", "<think>", "</think>", "", None, "<th", "ink>"]
    df = chunk_table(spark, [[(rng.choice(pieces), rng.choice([None, None, "", "t", "u"])) for _ in range(rng.randint(1, 12))] for _ in range(300)])
    got = [{r.reply: (r.answer, r.reasoning) for r in assistant.assemble_chunks(df, "reply", "seq", block).collect()} for block in (1, 4, 1000)]
    assert got[0] == got[1] == got[2]


def test_plain_chunks_equal_their_joined_text(spark):
    rng = random.Random(9)
    replies = [[(rng.choice(["a", "b\n", "<think>", "</think>", "<th", "ink>"]), None) for _ in range(rng.randint(1, 12))] for _ in range(300)]
    joined = spark.createDataFrame([(i, "".join(r for r, _ in c)) for i, c in enumerate(replies)], "reply int, text string")
    want = {r.reply: (r.answer, r.reasoning) for r in assistant.split_reasoning(joined, "text").collect()}
    got = {r.reply: (r.answer, r.reasoning) for r in assistant.assemble_chunks(chunk_table(spark, replies), "reply", "seq").collect()}
    assert got == want


def test_split_reasoning(spark):
    values = ["plain", "<think>a</think>b<think>c</think>d", "x<think>rest\n", "<think>a\nb</think>\n\nc", "<think></think>"]
    df = spark.createDataFrame([(v,) for v in values], "t string")
    got = [(r.reasoning, r.answer) for r in assistant.split_reasoning(df, "t").collect()]
    want = [(PATTERN.search(v).group(1) if "<think>" in v else "", PATTERN.sub("", v)) for v in values]
    assert got == want


def test_routing(spark):
    cases = {
        "Ciao!": (False, True, True),
        "  quali IP?  ": (True, False, False),
        "raccontami una storia": (False, False, False),
        "breve": (False, False, True),
        "esattamente 15c": (False, False, True),
        "esattamente 16ch": (False, False, False),
        "hi, is the database up and running?": (True, True, False),
    }
    df = spark.createDataFrame([(q,) for q in cases], "q string")
    got = assistant.route_questions(df, "q").collect()
    assert [tuple(r)[1:] for r in got] == list(cases.values())


def test_context_without_rows(spark):
    text = assistant.security_context(spark.createDataFrame([], BLOCKED), spark.createDataFrame([], ALERTS)).first()[0]
    assert text == (
        assistant.CONTEXT_HEAD + assistant.BLOCKS_HEAD + assistant.NO_BLOCKS + assistant.ALERTS_HEAD + assistant.NO_ALERTS
    )


def test_query_texts(spark):
    cases = {
        "select 1": True, "\n WITH t as (select 1) select * from t": True, "explain select 1": False,
        "select 1; DROP table t": False, "select droplet from t": True, "select replace(a, 'b') from t": True,
        "select replace (a) from t": False, "": False,
    }
    df = spark.createDataFrame([(q,) for q in cases], "q string")
    got = federated.sql_verdict(df, "q").collect()
    assert [r.allowed for r in got] == list(cases.values())


def test_join_repeats_rows_up_to_the_limit(spark):
    flows = spark.createDataFrame([("a",)] * 4 + [("b",)] * 9, "ipv4_src_addr string")
    packets = spark.createDataFrame([("a", "y"), ("a", "x"), ("b", None), ("b", "z")], "src string, summary string")
    got = [tuple(r) for r in federated.flows_with_packets(flows, packets).collect()]
    assert got == [("a", "x")] * 4 + [("a", "y")] * 4 + [("b", None)] * 2
