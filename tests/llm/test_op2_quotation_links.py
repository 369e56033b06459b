"""Quotes are cut out, linked to what they quote, and give the reading order."""

from wattline.llm.op2_quotation_links import link_quotes, running_max

ROWS = [
    (1, 0, "user", "Hello there my friend.\nHow are you doing today?"),
    (1, 1, "assistant", "> How are you doing today?\nI am fine, thanks for asking."),
    (1, 2, "user", "A different question about cats."),
    (1, 3, "assistant", "On Monday, X wrote:\n> > How are you doing today?\n> I am fine, thanks for asking.\n\nGood to hear that."),
    (1, 4, "user", "More on that good thing."),
    (1, 5, "user", ">a different question about CATS\nCats are great."),
    (1, 6, "user", "> Good to hear that\nindeed"),
    (2, 0, "user", None), (2, 1, "user", ""), (None, 0, "user", "> x"), (3, None, "user", "y"),
    (4, 0, "user", "> only a quote of nothing"), (4, 0, "user", "> only a quote of nothing"),
    (5, 0, "user", "I am fine, thanks for asking."), (5, 1, "user", "on a line of its own I wrote:"),
]


def test_links_and_order(spark):
    df = spark.createDataFrame(ROWS, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "'mine' AS place")
    found = link_quotes(df).collect()
    assert len(found) == len(ROWS)
    one = {r.turn: r for r in found if r.conv_id == 1}
    assert {t: r.reply_to for t, r in one.items()} == {0: None, 1: 0, 2: 1, 3: 1, 4: 3, 5: 2, 6: 3}
    assert [r.turn for r in sorted(one.values(), key=lambda r: r.place)] == [0, 1, 3, 6, 4, 2, 5]
    assert one[3].text == "Good to hear that." and (one[3].n_quoted, one[3].n_linked) == (2, 2)
    assert one[5].format == "<|user|>\nCats are great."
    by = {(r.conv_id, r.turn): r for r in found}
    assert by[2, 0].text is None and by[2, 1].reply_to == 0
    assert by[None, 0].reply_to is None and by[3, None].place is None
    assert by[4, 0].text == "" and by[4, 0].n_quoted == 1 and by[4, 0].n_linked == 0
    assert by[5, 1].text == "on a line of its own I wrote:"  # nothing is quoted after it
    assert link_quotes(df.limit(0)).count() == 0


def test_deep_branches(spark):
    """Each message quotes the one two turns before: paths grow by doubling and stay in order."""
    rows = [(1, t, "user", ("" if t < 2 else f"> message number {t - 2} says this\n") + f"message number {t} says this") for t in range(40)]
    found = link_quotes(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()
    assert {r.turn: r.reply_to for r in found} == {t: (None if t == 0 else t - 1 if t < 2 else t - 2) for t in range(40)}
    place = {r.turn: r.place for r in found}
    assert all(place[r.reply_to] < place[r.turn] for r in found if r.reply_to is not None)


def test_very_many_quoted_lines(spark):
    rows = [(1, 0, "u", "first line of it all"), (1, 1, "u", "\n".join(f"> line {i} is here" for i in range(8_000)) + "\nbye"), (1, 2, "u", "\n".join(("> " * (1 + i % 3)) + "first line of it all" for i in range(2_600)))]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "9 AS c", "'x' AS t", "1 AS u", "2 AS h", "3 AS p")
    found = {r.turn: r for r in link_quotes(df).collect()}
    assert (found[1].text, found[1].n_quoted, found[1].n_linked, found[1].c, found[1].t) == ("bye", 1, 0, 9, "x")
    assert (found[2].text, found[2].n_quoted, found[2].n_linked, found[2].reply_to) == ("", 2_600, 2_600, 0)


def test_running_max_over_segments(spark):
    rows = [(k, t, t * 7 % 5000 if t % 3 else None) for k in (1, 2) for t in range(0, 5000, 37)]
    df = spark.createDataFrame(rows, "k int, t bigint, v bigint")
    for before in (True, False):
        found = {(r.k, r.t): r.m for r in running_max(df, ["k"], "t", "v", "m", before).collect()}
        for k, t, _ in rows:
            seen = [v for k2, t2, v in rows if k2 == k and v is not None and (t2 < t if before else t2 <= t)]
            assert found[k, t] == (max(seen) if seen else None)
