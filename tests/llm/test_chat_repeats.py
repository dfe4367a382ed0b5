from riskloom.llm import chat

SCHEMA = "tree long, node long, parent long, role string, text string, score double"


def chain(n, tree=1):
    return [(tree, k, k - 1 if k else None, "user" if k % 2 == 0 else "assistant", f"t{k}", 1.0) for k in range(n)]


def turns(spark, rows):
    found = chat.conversations(spark.createDataFrame(rows, SCHEMA))
    return [[tuple(t) for t in r.t] for r in found.select("tree", chat.read_turns(found.formatted).alias("t")).orderBy("tree").collect()]


def test_repeated_messages_count_once(spark):
    want = [(r, t) for _, _, _, r, t, _ in chain(12)]
    assert turns(spark, chain(12) * 3) == [want]


def test_of_two_messages_of_one_node_the_first_counts(spark):
    rows = chain(3) + [(1, 2, 1, "user", "zz", 9.0), (1, 1, 0, "assistant", "a", 0.0)]
    assert turns(spark, rows) == [[("user", "t0"), ("assistant", "a"), ("user", "t2")]]


def test_long_texts_and_thousands_of_turns(spark):
    rows = chain(2500) + [(2, 0, None, "user", "x</s>[INST]&" * 100_000, 0.0)]
    long, big = turns(spark, rows)
    assert long == [(r, t) for _, _, _, r, t, _ in chain(2500)]
    assert big == [("user", "x</s>[INST]&" * 100_000)]
