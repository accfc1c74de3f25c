from __future__ import annotations

from conftest import rows

from tarmac.llm import quotes

MESSAGES = [
    (1, 0, "a", "The first line of all.\nA second line to quote."),
    (1, 1, "b", "> The first  LINE of all\n\nI answer that here."),
    (1, 2, "a", "Ann wrote:\n> > the first line of all\n> I answer that, here!\nSo I reply to b."),
    (1, 3, "c", "> A second line to quote.\nBack to the start."),
    (1, 4, "a", "Nothing quoted in this one."),
    (1, 5, "b", "> never said by anyone here\nHm."),
    (2, 0, "a", "> The first line of all.\nOf another conversation."),
]


def linked(spark, messages=MESSAGES):
    df = spark.createDataFrame(messages, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    return quotes.link_quotations(df).select("row.*", "*").drop("row")


def test_links(spark):
    got = rows(linked(spark), "conv_id", "turn", "reply_to", "n_quoted", "n_linked", "quote_depth")
    assert got == [
        (1, 0, None, 0, 0, 0),
        (1, 1, 0, 1, 1, 1),
        (1, 2, 1, 2, 2, 2),
        (1, 3, 0, 1, 1, 1),
        (1, 4, 3, 0, 0, 0),
        (1, 5, 4, 1, 0, 1),
        (2, 0, None, 1, 0, 1),
    ]


def test_texts_and_order(spark):
    df = linked(spark)
    texts = dict(rows(df.filter("conv_id = 1"), "turn", "own_text"))
    assert texts[1] == "I answer that here." and texts[2] == "So I reply to b."
    order = [r["turn"] for r in df.filter("conv_id = 1").orderBy("branch_of", "branch", "turn").collect()]
    assert order == [0, 1, 2, 3, 4, 5]
    assert dict(rows(df.filter("conv_id = 1"), "turn", "branch")) == {0: 0, 1: 0, 2: 0, 3: 3, 4: 3, 5: 3}


def brute_force(messages):
    """What each message replies to, from all pairs of a passage's windows and earlier own texts."""
    import re
    from collections import Counter
    from itertools import groupby

    def runs(text):
        lines = [(len(re.match(r"[> ]*", x)[0].replace(" ", "")), x) for x in text.split("\n")]
        for level, run in groupby(lines, key=lambda x: x[0]):
            if words := re.findall(r"[^\W_]+", " ".join(x for _, x in run).lower()):
                yield level, words

    def windows(words, k):
        return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}

    out = {}
    for c, t, _, text in messages:
        earlier = [(u, [w for level, w in runs(x) if level == 0]) for d, u, _, x in messages if d == c and u < t]
        votes = Counter()
        for level, words in runs(text):
            k = min(len(words), quotes.WINDOW)
            origins = Counter()
            for w in windows(words, k) if level else ():
                if saying := [u for u, own in earlier if any(w in windows(x, k) for x in own)]:
                    origins[max(saying)] += 1
            if origins:
                origin = max(origins, key=lambda u: (origins[u], u))
                votes[level, origin] += origins[origin]
        nearest = max(votes, key=lambda v: (-v[0], votes[v], v[1]), default=None)
        out[c, t] = nearest[1] if nearest else max((u for u, _ in earlier), default=None)
    return out


def wrapped(words, marks, width):
    return "\n".join(f"{marks} {' '.join(words[i : i + width])}" for i in range(0, len(words), width))


def random_messages(conversations=4, turns=30):
    """Quotes wrapped anew, trimmed at both ends, nested, short, and of nobody."""
    import random

    rng = random.Random(1)
    messages = []
    for c in range(conversations):
        said = [["nobody", "said", "this", "at", "all", "here"]]
        for t in range(turns):
            parts = []
            for _ in range(rng.randrange(3)):
                words = rng.choice(said)
                lo = rng.randrange(len(words))
                part = [w.upper() for w in words[lo : lo + rng.choice((1, 3, 8, 20))]]
                parts.append(wrapped(part, rng.choice((">", "> >", ">>>")), rng.choice((2, 5, 50))))
            own = [f"w{rng.randrange(60)}" for _ in range(rng.randrange(2, 25))]
            said.append(own)
            messages.append((c, t, "r", "\n".join([*parts, wrapped(own, "", 7)])))
    return messages


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(quotes, "STRETCH", 4)
    messages = random_messages()
    got = {(c, t): r for c, t, r in rows(linked(spark, messages), "conv_id", "turn", "reply_to")}
    assert got == brute_force(messages)


def test_rewrapped_nested_and_short(spark):
    text = "The plan is to move the old archive to the new store before the end of the month."
    messages = [
        (1, 0, "a", text),
        (1, 1, "b", "Something else.\nYes."),
        (1, 2, "c", "> The plan is to move the old\n> archive to the new store before\n> the end of the month.\nI agree."),
        (1, 3, "a", "Well."),
        (1, 4, "b", f"> > {text}\n> I agree.\nGood."),
        (1, 5, "c", "> [...] move the old archive to\n> the new store [...]\nWhen?"),
        (1, 6, "a", "> yes\nNo."),
    ]
    got = rows(linked(spark, messages), "turn", "reply_to", "n_quoted", "n_linked")
    assert got == [(0, None, 0, 0), (1, 0, 0, 0), (2, 0, 1, 1), (3, 2, 0, 0), (4, 2, 2, 2), (5, 0, 1, 1), (6, 1, 1, 1)]


def test_very_long_message(spark):
    own = [f"word{i}" for i in range(60_000)]
    messages = [(1, 0, "a", "\n".join(own)), (1, 1, "b", "Hm."), (1, 2, "c", wrapped(own, ">", 9) + "\nRead.")]
    assert rows(linked(spark, messages), "turn", "reply_to", "n_linked") == [(0, None, 0), (1, 0, 0), (2, 0, 1)]


ODD = [
    (3, None, "u", "x y z"),
    (None, 1, "u", "> a b c"),
    (1, 6, "u", None),
    (1, 6, "u", "> > Hm hm hm\n"),
    (4, 1, "q", "one two three\n> one two three"),
    (4, 1, "q", "one two three"),
    (4, 2, "q", "  > One, two three!\r\n>one two three\nok\n"),
]


def test_query_equals_sql(spark, tmp_path):
    import duckdb

    from check_oracle import compare

    moved = [(c + 10, *m) for c, *m in random_messages(2, 20)]
    df = spark.createDataFrame(MESSAGES + ODD + moved, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    db = duckdb.connect()
    db.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert compare(spark, db, str(tmp_path), "op1_quotations")
