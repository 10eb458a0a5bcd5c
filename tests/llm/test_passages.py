"""Repeated passages against brute force over all runs of lines."""

import random

from quarterdeck.llm import lines, shared

SCHEMA = "doc_id long, text string"


def runs_removed(rows):
    """Lines of every document that a run of two lines or more, equal to an earlier run apart from it, holds."""
    documents = sorted({(r[0] is None, r[0] or 0, r[1] or "") for r in rows})
    cut = [(d, [text[a:b].removesuffix("\n") for a, b in lines.line_spans(text)]) for d, (_, _, text) in enumerate(documents)]
    places = [(d, at, at + n, tuple(have[at : at + n])) for d, have in cut for n in range(2, len(have) + 1) for at in range(len(have) - n + 1)]
    first = {}
    for d, start, end, run in sorted(places):
        first.setdefault(run, (d, start, end))
    gone = {d: set() for d, _ in cut}
    for d, start, end, run in places:
        e, _, before = first[run]
        if e < d or e == d and before <= start:
            gone[d].update(range(start, end))
    return {(None if unnamed else key, text): gone[d] for d, (unnamed, key, text) in enumerate(documents)}


def check(spark, rows):
    wanted = runs_removed(rows)
    found = lines.remove_repeated_passages(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert len(found) == len(rows)
    texts = {r[0]: r[1] or "" for r in rows}
    for row in found:
        text = texts[row.doc_id]
        gone = wanted[row.doc_id, text]
        spans = lines.line_spans(text)
        assert row.clean_text == "".join(text[a:b] for i, (a, b) in enumerate(spans) if i not in gone)
        assert row.removed_lines == len(gone)
        assert {i for i, (a, b) in enumerate(spans) if any(s.start <= a and b <= s.end for s in row.removed_spans)} == gone
        assert row.removed_chunks == len([i for i in gone if i - 1 not in gone])
    return found


def test_every_repeated_run_goes(spark):
    """Passages of 2 to 20 lines between other lines, each in two documents, go whole from the later one."""
    draw, rows, lengths = random.Random(4), [], [2, 3, 4, 5, 6, 8, 12, 20] * 5
    for k, length in enumerate(lengths):
        passage = [f"shared {k} {i} é😀" for i in range(length)]
        for half in range(2):
            own = [[f"own {k} {half} {side} {i}" for i in range(draw.randint(0, 4))] for side in range(2)]
            rows.append((2 * k + half, "\n".join([*own[0], *passage, *own[1]])))
    found = check(spark, rows)
    assert sum(r.removed_lines for r in found) == sum(lengths)


def test_few_kinds_of_lines(spark):
    """Overlaps, repetitions within a text, blank lines, copies, missing ids and texts."""
    draw = random.Random(9)
    made = [(i, "".join(draw.choice("abcdefghijk") * draw.randint(0, 1) + "\n" for _ in range(draw.randint(0, 7)))) for i in range(40)]
    odd = [(50, None), (51, ""), (52, "z\nz\nz"), (53, "y\ny\ny\ny\ny"), (54, "p\nq\np\nq\np"), (None, "p\nq"), (55, "p\nq\n"), (3, made[3][1])]
    check(spark, made + odd)


def test_three_equal_lines_stay(spark):
    found = {r.doc_id: r.clean_text for r in check(spark, [(1, "x\nx\nx"), (2, "u\nu\nu\nu"), (3, "one"), (4, "one")])}
    assert found == {1: "x\nx\nx", 2: "u\nu\n", 3: "one", 4: "one"}


def with_hashes(monkeypatch, change):
    """Lets ``change`` alter every row of the scan that hashes chunks and pairs."""
    real = lines._chunk_rows

    def changed_scan(mean):
        run = real(mean)

        def changed(batches):
            import pyarrow as pa

            for batch in run(batches):
                yield pa.RecordBatch.from_pylist([r | change(r) for r in batch.to_pylist()], schema=batch.schema)

        return changed

    monkeypatch.setattr(lines, "_chunk_rows", changed_scan)


ALIKE = [(1, "a\nb\nc"), (2, "x\na\nb"), (3, "c\nd\ne"), (4, "d\ne\nf\ng"), (5, "a\nb\nc"), (6, "h\na\nb\nc\nd\ne\nh")]


def test_equal_pair_hashes_are_not_enough(spark, monkeypatch):
    with_hashes(monkeypatch, lambda r: {"pairs": [0] * len(r["pairs"])})
    check(spark, ALIKE)


def test_equal_chunk_hashes_are_not_enough(spark, monkeypatch):
    """Chunks alike in hash only do not go, and the pairs in them are looked up after all."""
    with_hashes(monkeypatch, lambda r: {"hash": b"0"})
    check(spark, ALIKE)


def test_equal_short_keys_are_not_enough(spark, monkeypatch):
    """Documents asked for each other's runs, beyond their own end too, answer for themselves."""
    real = lines.asked_runs

    def all_asked(chunks, copies):
        from pyspark.sql import functions as F

        runs = real(chunks, copies).select(F.explode("asked").alias("run")).distinct()
        every = chunks.select(F.xxhash64("row").alias("short")).distinct()
        return every.crossJoin(runs).groupBy("short").agg(F.collect_set("run").alias("asked"))

    monkeypatch.setattr(lines, "asked_runs", all_asked)
    check(spark, ALIKE)


def test_passages_of_nothing(spark):
    assert lines.remove_repeated_passages(spark.createDataFrame([], SCHEMA)).count() == 0


def test_flag_leaves_out_no_asked_document(spark):
    docs = spark.range(20_000).selectExpr("id", "'' AS text", "concat('r', id) AS row")
    asked = docs.filter("id % 5 = 0").select("row")
    found = {r.id: r.may for r in shared.may_hold(docs, asked, "row", "may").collect()}
    assert len(found) == 20_000 and all(found[i] for i in range(0, 20_000, 5))
    assert sum(found.values()) < 4100
