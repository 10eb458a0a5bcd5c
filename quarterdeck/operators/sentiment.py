"""Buyer tone of each deal, early against late.

A deal's early text is what buyers said in the first half of its calls plus the
e-mails up to its last call; the late text is the rest.  Neither text is ever put
together: rows are counted in place (``functions.tone``) and the counts are
merged in small ordered steps, so one deal may hold any share of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.functions import tone
from quarterdeck.functions.dates import written_day
from quarterdeck.functions.text import strip
from quarterdeck.operators.contracts import require_columns
from quarterdeck.operators.ordering import positions
from quarterdeck.operators.skew import salted_join
from quarterdeck.params import ToneRules
from quarterdeck.sources.writers import Keep, not_kept

TRANSCRIPT_COLUMNS = ("deal_id", "call_date", "call_num", "turn_num", "speaker", "turn_text")
EMAIL_COLUMNS = ("deal_id", "body", "timestamp")

EARLY, LATE = "early", "late"

# Rows merged at once: turns of a call by number, calls of a day by number, e-mails by ordinal.
_TURN_SHIFT = 16
_CALL_SHIFT = 12
_EMAIL_SHIFT = 16
# Blocks are merged this many bits at a time, so no list is longer than 2^10 blocks.
_FAN_IN_BITS = 10


def buyer_turns(transcripts: DataFrame) -> DataFrame:
    return transcripts.filter(F.contains(F.lower("speaker"), F.lit("buyer")))


def ordered_turns(transcripts: DataFrame) -> DataFrame:
    """Buyer turns with their 0-based position in the deal's (call_date, call_num, turn_num) order."""
    keyed = buyer_turns(transcripts).withColumns(
        {
            "deal_id": strip(F.col("deal_id").cast("string")),
            "call_date": F.coalesce("call_date", F.lit("")),
            "turn_num": F.coalesce("turn_num", F.lit(0)),
        }
    )
    valid = keyed.filter(F.col("call_num").isNotNull())
    blocks = [
        F.col("call_date"),
        F.shiftright("call_num", _CALL_SHIFT),
        F.col("call_num"),
        F.shiftright("turn_num", _TURN_SHIFT),
    ]
    return positions(valid, ["deal_id"], blocks, ["turn_num", "ordinal"])


def call_halves(transcripts: DataFrame) -> DataFrame:
    """Every distinct buyer call of a deal with the halves it belongs to.

    Of n calls by number the first n // 2 are early and the rest late; a single
    call is both.
    """
    calls = (
        buyer_turns(transcripts)
        .filter(F.col("call_num").isNotNull())
        .select(strip(F.col("deal_id").cast("string")).alias("deal_id"), "call_num")
        .distinct()
    )
    ranked = positions(
        calls, ["deal_id"], [F.shiftright("call_num", _CALL_SHIFT)], ["call_num"], "call_rank", "call_count"
    )
    early = F.col("call_rank") < F.floor(F.col("call_count") / 2)
    halves = (
        F.when(F.col("call_count") == 1, F.array(F.lit(EARLY), F.lit(LATE)))
        .when(early, F.array(F.lit(EARLY)))
        .otherwise(F.array(F.lit(LATE)))
    )
    return ranked.withColumn("halves", halves)


def call_cutoffs(transcripts: DataFrame) -> DataFrame:
    """Last day with any call, buyer turns or not; unreadable dates are skipped."""
    day = written_day(F.col("call_date"))
    return (
        transcripts.select(strip(F.col("deal_id").cast("string")).alias("deal_id"), day.alias("day"))
        .groupBy("deal_id")
        .agg(F.max("day").alias("cutoff"))
    )


def email_halves(emails: DataFrame, transcripts: DataFrame) -> DataFrame:
    """E-mails marked late after the deal's last call, or when either date is unknown."""
    sent = written_day(F.col("timestamp"))
    dated = emails.withColumn("deal_id", strip(F.col("deal_id").cast("string"))).withColumn("sent", sent)
    joined = salted_join(dated, call_cutoffs(transcripts), ["deal_id"], ["ordinal"])
    late = F.col("cutoff").isNull() | F.col("sent").isNull() | (F.col("sent") > F.col("cutoff"))
    return joined.withColumn("half", F.when(late, F.lit(LATE)).otherwise(F.lit(EARLY))).drop("sent", "cutoff")


def text_scores(df: DataFrame, column: str, rules: ToneRules) -> DataFrame:
    """Adds ``score``: the tone of one text per row, phrases included; 0 for a null text."""
    tone.check_words([*rules.positive, *rules.negative])
    # One column per step, so that the text is lower-cased once and each word counted once.
    lowered = df.withColumn("_text", F.lower(F.coalesce(F.col(column), F.lit(""))))
    counted = lowered.withColumns(
        {
            "_pos": F.expr(tone.hits("_text", [w.lower() for w in rules.positive])),
            "_neg": F.expr(tone.hits("_text", [w.lower() for w in rules.negative])),
        }
    )
    return counted.withColumn("score", F.expr(tone.balance("_pos", "_neg"))).drop("_text", "_pos", "_neg")


class _Counter:
    """The columns that carry one row's counts, and how to merge them in order."""

    def __init__(self, rules: ToneRules) -> None:
        tone.check_words([*rules.positive, *rules.negative])
        self.positive = tone.plain_words(rules.positive)
        self.negative = tone.plain_words(rules.negative)
        positive_phrases = tone.phrases(rules.positive)
        self.phrases = [*positive_phrases, *tone.phrases(rules.negative)]
        self.positive_slots = range(len(positive_phrases))
        self.negative_slots = range(len(positive_phrases), len(self.phrases))

    def count(self, df: DataFrame, text: str) -> DataFrame:
        """Adds the counts of each row's text; a null text counts nothing and adds no join.

        The lower-cased and marked texts are columns of their own, so each is made once per row.
        """
        lowered = df.withColumn("_text", F.lower(F.col(text)))
        pos, neg = tone.hits("_text", self.positive), tone.hits("_text", self.negative)
        if not self.phrases:
            return lowered.withColumns(
                {"_pos": F.expr(f"coalesce({pos}, 0L)"), "_neg": F.expr(f"coalesce({neg}, 0L)")}
            )
        cuts = {f"_cut{i}": p for i, p in enumerate(self.phrases)}
        joined = lowered.withColumn("_joined", F.concat(F.lit(" "), F.col("_text")))
        cut = joined.withColumns({c: F.expr(tone.marked("_joined", p)) for c, p in cuts.items()})
        live = " OR ".join(f"{tone.continues('_joined', p)} OR {tone.leaves_open(c, p)}" for c, p in cuts.items())
        own = [tone.own_hits("_joined", c, p) for c, p in cuts.items()]
        tables = ", ".join(tone.phrase_steps("_joined", c, p) for c, p in cuts.items())
        counted = {
            "_pos": F.expr(f"coalesce({pos} + {self._settled(own, self.positive_slots)}, 0L)"),
            "_neg": F.expr(f"coalesce({neg} + {self._settled(own, self.negative_slots)}, 0L)"),
            "_here": F.col("_text").isNotNull(),
            "_steps": F.expr(f"CASE WHEN _live THEN array({tables}) END"),
        }
        return cut.withColumn("_live", F.expr(live)).withColumns(counted).drop("_joined", "_live", *cuts)

    def _settled(self, own: Sequence[str], slots: Sequence[int]) -> str:
        """Phrase matches of a row whose table is not kept."""
        return f"CASE WHEN _live THEN 0L ELSE {' + '.join(['0L', *(own[i] for i in slots)])} END"

    def names(self) -> list[str]:
        return ["_pos", "_neg", *(["_here", "_steps"] if self.phrases else [])]

    def merged(self, order: Sequence[str], only: str = "true") -> str:
        """Aggregates, as one struct, over the rows of a group in ``order`` where ``only`` holds."""
        sums = ", ".join(f"'{c}', coalesce(sum(CASE WHEN {only} THEN {c} END), 0L)" for c in ("_pos", "_neg"))
        if not self.phrases:
            return f"named_struct({sums})"
        entry = f"CASE WHEN {only} AND _here THEN struct({', '.join(order)}, _steps) END"
        ordered = f"sort_array(collect_list({entry}))._steps"
        return f"named_struct({sums}, '_here', bool_or(_here), '_tables', {tone.compose(ordered, self.phrases)})"

    def merge(self, df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
        """Rows of a group merged to one of the same columns."""
        flat = df.groupBy(*group).agg(F.expr(self.merged(order)).alias("_m")).select(*group, "_m.*")
        if not self.phrases:
            return flat
        own = [f"_tables[{i}][0].n" for i in range(len(self.phrases))]
        return flat.withColumn("_live", F.expr(tone.is_live("_tables"))).select(
            *group,
            F.expr(f"_pos + {self._settled(own, self.positive_slots)}").alias("_pos"),
            F.expr(f"_neg + {self._settled(own, self.negative_slots)}").alias("_neg"),
            "_here",
            F.expr("CASE WHEN _live THEN _tables END").alias("_steps"),
        )

    def score(self, counts: str) -> Column:
        """Tone score of a struct of merged counts, 0 without any row."""
        sides = []
        for side, slots in (("_pos", self.positive_slots), ("_neg", self.negative_slots)):
            phrased = f" + {tone.phrase_hits(f'{counts}._tables', slots)}" if self.phrases else ""
            sides.append(f"({counts}.{side}{phrased})")
        return F.expr(tone.balance(*sides))


# A block's place in its half: calls by date and number first, then e-mails by ordinal.
_PLACE = ("source", "day", "block")


def _counted_turns(transcripts: DataFrame, counter: _Counter) -> DataFrame:
    """Every turn with its counts in place of its text.  Only placed buyer turns are counted; the others
    stay because cut-offs and spans look at them."""
    used = F.contains(F.lower("speaker"), F.lit("buyer")) & F.col("call_num").isNotNull()
    turns = transcripts.select(*(c for c in TRANSCRIPT_COLUMNS if c != "turn_text"), "ordinal",
                               F.when(used, F.col("turn_text")).alias("_counted"))
    return counter.count(turns, "_counted").drop("_counted", "_text")


def _counted_mails(emails: DataFrame, counter: _Counter) -> DataFrame:
    """Every e-mail with its counts in place of its body."""
    return counter.count(emails.select(*EMAIL_COLUMNS, "ordinal"), "body").drop("body", "_text")


def _call_blocks(counted: DataFrame, counter: _Counter) -> DataFrame:
    turns = (
        buyer_turns(counted)
        .filter(F.col("call_num").isNotNull())
        .select(
            strip(F.col("deal_id").cast("string")).alias("deal_id"),
            F.coalesce("call_date", F.lit("")).alias("day"),
            "call_num",
            F.coalesce("turn_num", F.lit(0)).alias("turn_num"),
            F.shiftright(F.coalesce("turn_num", F.lit(0)), _TURN_SHIFT).alias("turn_block"),
            "ordinal",
            *counter.names(),
        )
    )
    calls = counter.merge(turns, ["deal_id", "day", "call_num", "turn_block"], ["turn_num", "ordinal"])
    halves = call_halves(counted).select("deal_id", "call_num", F.explode("halves").alias("half"))
    split = calls.join(halves, ["deal_id", "call_num"]).withColumn(
        "block", F.shiftright("call_num", _CALL_SHIFT).cast("long")
    )
    blocks = counter.merge(split, ["deal_id", "half", "day", "block"], ["call_num", "turn_block"])
    # Call numbers have 31 bits: two steps leave one row per day; days then merge by month.
    days = _merge_blocks(blocks, counter, ["deal_id", "half", "day"], steps=2)
    months = days.withColumn("month", F.substring("day", 1, 7))
    merged = counter.merge(months, ["deal_id", "half", "month"], ["day", "block"])
    return merged.withColumnRenamed("month", "day").withColumns({"source": F.lit(0), "block": F.lit(0).cast("long")})


def _merge_blocks(blocks: DataFrame, counter: _Counter, group: list[str], steps: int) -> DataFrame:
    """Neighbouring blocks merged step by step, a bounded number at a time."""
    for _ in range(steps):
        wider = blocks.withColumn("_wide", F.shiftright("block", _FAN_IN_BITS))
        blocks = counter.merge(wider, [*group, "_wide"], ["block"]).withColumnRenamed("_wide", "block")
    return blocks


def _email_blocks(counted: DataFrame, turns: DataFrame, counter: _Counter) -> DataFrame:
    split = email_halves(counted, turns).withColumn(
        "block", F.shiftright(F.col("ordinal").cast("long"), _EMAIL_SHIFT)
    )
    blocks = counter.merge(split, ["deal_id", "half", "block"], ["ordinal"])
    # Ordinals of many input splits have some 50 bits; three steps leave a few blocks.
    return _merge_blocks(blocks, counter, ["deal_id", "half"], steps=3).withColumns({"source": F.lit(1), "day": F.lit("")})


def _half_scores(turns: DataFrame, mails: DataFrame, counter: _Counter) -> DataFrame:
    """Early and late tone score of every deal with any text, from counted turns and e-mails."""
    blocks = _call_blocks(turns, counter).unionByName(_email_blocks(mails, turns, counter))
    merged = blocks.groupBy("deal_id").agg(
        *(F.expr(counter.merged(_PLACE, f"half = '{half}'")).alias(half) for half in (EARLY, LATE))
    )
    return merged.select(
        "deal_id", counter.score(EARLY).alias("early_score"), counter.score(LATE).alias("late_score")
    )


def signal_span(transcripts: DataFrame, emails: DataFrame) -> DataFrame:
    """Buyer turns, e-mails, and first and last date text of either, compared as text."""
    turns = buyer_turns(transcripts).select(
        strip(F.col("deal_id").cast("string")).alias("deal_id"),
        F.nullif(strip(F.col("call_date").cast("string")), F.lit("")).alias("signal_at"),
        F.lit(1).alias("turn"),
        F.lit(0).alias("email"),
        F.col("call_num").isNull().cast("int").alias("bad_call"),
    )
    mails = emails.select(
        strip(F.col("deal_id").cast("string")).alias("deal_id"),
        F.nullif(strip(F.col("timestamp").cast("string")), F.lit("")).alias("signal_at"),
        F.lit(0).alias("turn"),
        F.lit(1).alias("email"),
        F.lit(0).alias("bad_call"),
    )
    return (
        turns.unionByName(mails)
        .groupBy("deal_id")
        .agg(
            F.sum("turn").alias("buyer_turn_count"),
            F.sum("email").alias("email_count"),
            F.sum("bad_call").alias("unplaced_turn_count"),
            F.min("signal_at").alias("first_signal_at"),
            F.max("signal_at").alias("last_signal_at"),
        )
    )


def deal_sentiment(
    requested: DataFrame, transcripts: DataFrame, emails: DataFrame, rules: ToneRules, keep: Keep = not_kept
) -> DataFrame:
    """``requested`` with late score, trajectory, decline flag and signal span.

    Halves, cut-offs, merges and spans all work on per-row counts without texts.  With ``keep``
    these two tables are stored, so transcripts and e-mails are read once each.
    """
    require_columns(transcripts, [*TRANSCRIPT_COLUMNS, "ordinal"])
    require_columns(emails, [*EMAIL_COLUMNS, "ordinal"])
    counter = _Counter(rules)
    turns = keep(_counted_turns(transcripts, counter), "turn_counts")
    mails = keep(_counted_mails(emails, counter), "email_counts")
    joined = requested.join(_half_scores(turns, mails, counter), "deal_id", "left").join(
        signal_span(turns, mails), "deal_id", "left"
    )
    zero = F.lit(0).cast("long")
    late = F.coalesce("late_score", F.lit(0.0))
    trajectory = late - F.coalesce("early_score", F.lit(0.0))
    counts = ("buyer_turn_count", "email_count", "unplaced_turn_count")
    return joined.withColumns(
        {
            "sentiment_score": late,
            "tone_trajectory": trajectory,
            "sentiment_decline_flag": trajectory < rules.decline_threshold,
            "window_count": F.lit(2),
            **{c: F.coalesce(c, zero) for c in counts},
        }
    ).drop("early_score", "late_score")
