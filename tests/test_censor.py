"""Golden scenarios of the censor (printed and derived cases) and its
properties."""

from hypothesis import given, settings, strategies as st

from streamfold.functions.text import normalize_word, rune_upper, unicode_trim
from streamfold.operators import blocklist, censor, dictionary



def words_df(spark, words):
    return dictionary.bad_word_dictionary(
        spark.createDataFrame([(w,) for w in words], "word string"))


def msgs_df(spark, rows):
    return spark.createDataFrame(rows, "id bigint, from_user_id string, to_user_id string, text string")


def no_blocks(spark):
    return spark.createDataFrame([], "user_id string, blocked_id string")


def run(spark, msgs, blocks, words):
    out = censor.censor_messages(msgs, blocks, words)
    return {r.id: r.text for r in out.collect()}


def test_empty_dictionary_passes_text(spark):
    m = msgs_df(spark, [(1, "1", "2", "плохо bad")])
    assert run(spark, m, no_blocks(spark), words_df(spark, [])) == {1: "плохо bad"}


def test_mask_and_case_and_punctuation(spark):
    m = msgs_df(spark, [(1, "1", "2", "плохо bad"), (2, "1", "2", "Плохо, БАД! x2"),
                        (3, "1", "2", "   "), (4, "1", "2", ""), (5, "1", "2", None)])
    got = run(spark, m, no_blocks(spark), words_df(spark, ["плохо"]))
    assert got == {1: "***** bad", 2: "*****, БАД! x2", 3: "   ", 4: "", 5: None}


def test_repeated_messages_stay_apart(spark):
    """Messages that repeat, or share all but the text, are kept as they are."""
    rows = [(1, "1", "2", "bad day"), (1, "1", "2", "good bad"), (1, "1", "2", "x"), (1, "1", "2", "x"),
            (None, None, None, "Bad"), (1, "1", "2", None), (1, "1", "2", None)]
    out = censor.censor_messages(msgs_df(spark, rows), no_blocks(spark), words_df(spark, ["bad"]))
    assert sorted((r.text for r in out.collect()), key=str) == sorted(
        ["*** day", "good ***", "x", "x", "***", None, None], key=str)


def test_unmatchable_word(spark):
    m = msgs_df(spark, [(1, "1", "2", "bad2 bad"), (2, "1", "2", "a 123 b")])
    got = run(spark, m, no_blocks(spark), words_df(spark, ["bad2", "123"]))
    assert got == {1: "bad2 bad", 2: "a 123 b"}


def test_word_normalisation(spark):
    d = words_df(spark, ["  Bad ", "bad", "   ", " Ärger　"])
    assert sorted(tuple(r) for r in d.collect()) == [("bad", "***"), ("ärger", "*****")]
    assert [r.word for r in dictionary.unmatchable_words(words_df(spark, ["bad word", "ok"])).collect()] \
        == ["bad word"]


def test_block_unblock_scenario(spark):
    """Printed scenario: block 2<-1 drops the message; unblock lets it pass masked."""
    words = words_df(spark, ["плохо"])
    m = msgs_df(spark, [(7, "1", "2", "плохо bad")])
    ev = spark.createDataFrame([("2", "block:2:1", 1)], "key string, value string, offset bigint")
    good, bad = blocklist.parse_block_events(ev)
    assert bad.count() == 0
    assert [tuple(r) for r in blocklist.block_list(good).collect()] == [("2", "1")]
    assert run(spark, m, blocklist.current_blocks(good), words) == {}
    assert [r.id for r in censor.blocked_messages(m, blocklist.current_blocks(good)).collect()] == [7]
    ev2 = spark.createDataFrame([("2", "block:2:1", 1), ("2", "unblock:2:1", 2)],
                                "key string, value string, offset bigint")
    good2, _ = blocklist.parse_block_events(ev2)
    assert [tuple(r) for r in blocklist.block_list(good2).collect()] == [("2", None)]
    assert run(spark, m, blocklist.current_blocks(good2), words) == {7: "***** bad"}


def test_malformed_and_unknown_user(spark):
    ev = spark.createDataFrame(
        [("1", "bad", 1), ("1", "a:b", 2), ("1", "block:1:2:3", 3), ("1", "mute:1:2", 4),
         ("9", "unblock:9:1", 5)], "key string, value string, offset bigint")
    good, bad = blocklist.parse_block_events(ev)
    reasons = sorted(r.reason for r in bad.collect())
    assert reasons == ["invalid format"] * 3 + ["unknown action"]
    assert [tuple(r) for r in blocklist.block_list(good).collect()] == [("9", None)]
    req = spark.createDataFrame([("9",), ("5",)], "user_id string")
    got = sorted(tuple(r) for r in blocklist.lookup_user_blocks(req, blocklist.block_list(good)).collect())
    assert got == [("5", None, "not_found"), ("9", None, "found")]


def test_block_fold_ignores_partitioning(spark):
    rows = [(str(i % 5), f"{'block' if i % 3 else 'unblock'}:{i % 5}:{i % 4}", i) for i in range(300)]
    ev = spark.createDataFrame(rows, "key string, value string, offset bigint")
    a = blocklist.block_list(blocklist.parse_block_events(ev.repartition(1))[0])
    b = blocklist.block_list(blocklist.parse_block_events(ev.repartition(7, "offset"))[0])
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


text_alphabet = st.sampled_from(list("abcXYZ плохоБАД,.!12éß"))


@settings(max_examples=15, deadline=None)
@given(texts=st.lists(st.text(text_alphabet, max_size=30), min_size=1, max_size=5))
def test_masking_properties(spark, texts):
    """Length in code points is kept; masking twice equals masking once."""
    words = words_df(spark, ["abc", "плохо", "xyz", "бад"])
    m = msgs_df(spark, [(i, "1", "2", t) for i, t in enumerate(texts)])
    once = run(spark, m, no_blocks(spark), words)
    for i, t in enumerate(texts):
        assert len(once[i]) == len(t)
    m2 = msgs_df(spark, [(i, "1", "2", once[i]) for i in range(len(texts))])
    assert run(spark, m2, no_blocks(spark), words) == once


def test_text_functions(spark):
    df = spark.createDataFrame([("straße ﬀ ᾳ abc",), ("   x y\t\u0085",), ("​z",)], "t string")
    got = [tuple(r) for r in df.select(rune_upper("t"), unicode_trim("t"), normalize_word("t")).collect()]
    assert got[0][0] == "STRAßE ﬀ ᾼ ABC"
    assert got[1][1] == "x y"
    assert got[2][1] == "​z"      # zero-width space is not white space


def _lists(spark, n, long=False):
    words = [(f"{'w' * 70 if long else 'w'}{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}",) for i in range(n)]
    return dictionary.bad_word_dictionary(spark.createDataFrame(words, "word string"))


def test_short_and_long_lists_mask_alike(spark):
    """The set and the join give the same texts, on either side of the bound."""
    from streamfold.operators import censor
    words = _lists(spark, 300)
    rows = [(i, str(i % 3), "9", t) for i, t in enumerate([None, "", "waaa Wbaa, x", "wzza waaa", "waaaw", "waba-WABA éwcaa", "waaa Wbaa, x"])]
    msgs = spark.createDataFrame(rows, "id int, from_user_id string, to_user_id string, text string")
    want = {0: None, 1: "", 2: "**** ****, x", 3: "wzza ****", 4: "waaaw", 5: "****-**** éwcaa", 6: "**** ****, x"}
    for most in (0, 299, 300, 1 << 16):
        got = censor.mask_messages(msgs, words, set_words=most)
        assert {r.id: r.text for r in got.collect()} == want and got.columns == msgs.columns
    long = censor.mask_messages(spark.createDataFrame([(1, "a " + "w" * 70 + "aaa")], "id int, text string"), _lists(spark, 3, True))
    assert long.first().text == "a " + "*" * 73         # too long a word for the set: joined
    none = censor.mask_messages(msgs, words.limit(0))
    assert {r.id: r.text for r in none.collect()} == {r[0]: r[3] for r in rows}


def test_way_is_chosen_while_the_query_runs(spark):
    """A short list: no message and no word leaves its task, and the way of
    the join is gone from the final plan; a long list: a word is tested
    before it is shuffled."""
    from streamfold.operators import censor
    from tests.test_plans import plan
    msgs = spark.createDataFrame([(1, "waaa b")], "id int, text string")
    for most, short in ((1 << 16, True), (10, False)):
        df = censor.mask_messages(msgs, _lists(spark, 30), set_words=most)
        df.collect()
        final = plan(df, "simple").split("== Final Plan ==")[1].split("== Initial Plan ==")[0]
        assert ("_sf_key" in final) != short and "Union" not in final.split("Subquery")[0]
    words = [line for line in final.splitlines()]
    test = next(i for i, line in enumerate(words) if "Filter getbit" in line or "getbit(" in line and "Filter" in line)
    made = next(i for i, line in enumerate(words) if "Generate explode" in line)
    assert test < made and not any("Exchange" in line for line in words[test:made])
