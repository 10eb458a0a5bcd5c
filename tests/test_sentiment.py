import random

import pytest

from quarterdeck.operators import sentiment
from quarterdeck.params import ToneRules

TURN = "deal_id string, call_date string, call_num int, turn_num int, speaker string, turn_text string, ordinal long"
MAIL = "deal_id string, body string, timestamp string, ordinal long"


def ids(spark, *deals):
    return spark.createDataFrame([(d,) for d in deals], "deal_id string")


def score(spark, turns, mails, rules, deals=("D",)):
    out = sentiment.deal_sentiment(
        ids(spark, *deals), spark.createDataFrame(turns, TURN), spark.createDataFrame(mails, MAIL), rules
    )
    return {r["deal_id"]: r for r in out.collect()}


def buyer(call, turn, text, day="2026-01-01", deal="D"):
    return (deal, day, call, turn, "Kim (Buyer)", text, call * 100 + turn)


def expected(turns, mails, words):
    """Both texts joined in memory: the plain reading of the rule."""
    turns = [t for t in turns if "buyer" in t[4].lower()]
    calls = sorted({t[2] for t in turns})
    half = len(calls) // 2
    early = calls if len(calls) == 1 else calls[:half]
    late = calls[half:]
    cutoff = max((t[1] for t in turns), default=None)

    def text(chosen, mail_late):
        said = sorted((t for t in turns if t[2] in chosen), key=lambda t: (t[1], t[2], t[3], t[6]))
        written = [m for m in mails if (cutoff is None or m[2] is None or m[2][:10] > cutoff) == mail_late]
        parts = [t[5] for t in said] + [m[1] for m in sorted(written, key=lambda m: m[3])]
        return " ".join(parts).lower()

    def tone(value):
        pos = sum(value.count(w) for w in words.positive)
        neg = sum(value.count(w) for w in words.negative)
        return (pos - neg) / (pos + neg) if pos + neg else 0.0

    late_score = tone(text(late, True))
    return late_score, late_score - tone(text(early, False))


def test_single_call_counts_in_both_halves(spark):
    got = score(spark, [buyer(1, 1, "Great progress"), buyer(1, 2, "some RISK")], [], ToneRules())["D"]
    assert got["sentiment_score"] == pytest.approx(1 / 3) and got["tone_trajectory"] == 0
    assert not got["sentiment_decline_flag"] and got["buyer_turn_count"] == 2


def test_odd_calls_put_the_middle_one_late(spark):
    turns = [buyer(1, 1, "great"), buyer(2, 1, "delay"), buyer(3, 1, "delay")]
    got = score(spark, turns, [], ToneRules())["D"]
    assert (got["sentiment_score"], got["tone_trajectory"], got["sentiment_decline_flag"]) == (-1.0, -2.0, True)


def test_phrase_over_turns_and_into_emails(spark):
    turns = [buyer(1, 1, "it is up in"), buyer(1, 2, "the"), buyer(1, 3, "air happy")]
    got = score(spark, turns, [], ToneRules())["D"]
    assert got["sentiment_score"] == 0.0  # one phrase against one word
    late = [buyer(1, 1, "all up")]
    mails = [("D", "in the air", "2026-01-02 08:00:00", 1)]
    assert score(spark, late, mails, ToneRules())["D"]["sentiment_score"] == -1.0


def test_email_halves(spark):
    turns = [buyer(1, 1, "hello"), ("D", "2026-02-01", 9, 1, "Lee (Rep)", "x", 5)]
    mails = [
        ("D", "great", "2026-02-01 23:00:00", 1),
        ("D", "delay", "2026-02-02 00:00:00", 2),
        ("D", "risk", None, 3),
        ("D", "pause", "soon", 4),
        ("E", "worried", "2020-01-01 00:00:00", 5),
    ]
    split = sentiment.email_halves(spark.createDataFrame(mails, MAIL), spark.createDataFrame(turns, TURN))
    assert {r["ordinal"]: r["half"] for r in split.collect()} == {1: "early", 2: "late", 3: "late", 4: "late", 5: "late"}
    got = score(spark, turns, mails, ToneRules(), ("D", "E", "F"))
    assert (got["D"]["sentiment_score"], got["D"]["tone_trajectory"]) == (-1.0, -2.0)
    assert (got["D"]["email_count"], got["D"]["first_signal_at"], got["D"]["last_signal_at"]) == (4, "2026-01-01", "soon")
    assert (got["E"]["sentiment_score"], got["E"]["buyer_turn_count"]) == (-1.0, 0)
    assert (got["F"]["sentiment_score"], got["F"]["sentiment_decline_flag"], got["F"]["last_signal_at"]) == (0.0, False, None)


def test_missing_texts_and_calls_are_skipped(spark):
    turns = [buyer(1, 1, None), buyer(1, 2, "great"), ("D", "2026-03-01", None, 1, "Buyer", "delay", 7)]
    got = score(spark, turns, [("D", None, None, 1)], ToneRules())["D"]
    assert (got["sentiment_score"], got["unplaced_turn_count"], got["buyer_turn_count"]) == (1.0, 1, 3)


@pytest.mark.parametrize("word", ["", " risk", "risk ", "a\0b"])
def test_unusable_words_are_refused(spark, word):
    with pytest.raises(ValueError, match="tone word"):
        score(spark, [], [], ToneRules(positive=(word,)))


def test_against_joined_text(spark):
    """Random turns over a tiny alphabet; phrases overlap themselves and reach over several rows."""
    words = ToneRules(positive=("a", "aa", "a a", "b a b"), negative=("b", "a b a b", "a  a", "é a"))
    rng = random.Random(7)
    turns, mails, deals = [], [], [f"D{i}" for i in range(120)]

    def text():
        return "".join(rng.choice("aaabbé A ") for _ in range(rng.randint(0, 6)))

    for deal in deals:
        for call in range(1, rng.randint(1, 6)):
            day = f"2026-01-{rng.randint(1, 9):02d}"
            for turn in range(rng.randint(1, 5)):
                who = rng.choice(["Buyer", "the buyer", "Rep"])
                turns.append((deal, day, call, turn, who, text(), len(turns)))
        for _ in range(rng.randint(0, 5)):
            day = f"2026-01-{rng.randint(1, 12):02d} 10:00:00"
            mails.append((deal, text(), rng.choice([day, day, None]), len(mails)))
    # The cutoff looks at all turns of a deal, so give each rep turn the last buyer date at most.
    last = {}
    for t in turns:
        if "buyer" in t[4].lower():
            last[t[0]] = max(last.get(t[0], ""), t[1])
    turns = [t if "buyer" in t[4].lower() or t[0] in last and t[1] <= last[t[0]] else None for t in turns]
    turns = [t for t in turns if t]
    got = score(spark, turns, mails, words, deals)
    for deal in deals:
        want = expected([t for t in turns if t[0] == deal], [m for m in mails if m[0] == deal], words)
        assert (got[deal]["sentiment_score"], got[deal]["tone_trajectory"]) == pytest.approx(want), deal


def test_turn_positions(spark):
    turns = [buyer(2, 1, "c"), buyer(1, 2, "b"), buyer(1, 1, "a"), buyer(3, 1, "z", day="2025-12-31"), buyer(1, 1, "o", deal="E")]
    placed = sentiment.ordered_turns(spark.createDataFrame(turns, TURN))
    got = {(r["deal_id"], r["turn_text"]): r["position"] for r in placed.collect()}
    assert got == {("D", "z"): 0, ("D", "a"): 1, ("D", "b"): 2, ("D", "c"): 3, ("E", "o"): 0}


def test_text_scores(spark):
    texts = spark.createDataFrame([("Excited, not worried: up in the air",), (None,), ("",)], "t string")
    scored = sentiment.text_scores(texts, "t", ToneRules())
    assert {r["t"]: round(r["score"], 6) for r in scored.collect()} == {
        "Excited, not worried: up in the air": round(-1 / 3, 6),
        None: 0.0,
        "": 0.0,
    }
