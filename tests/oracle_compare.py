"""Compares a Spark result with its SQL twin."""

from __future__ import annotations

import math

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, bool) or value is None:
        return str(value)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return str(value)


def compare(frame, con, sql):
    got = [tuple(norm(v) for v in (row[c] for c in sorted(frame.columns))) for row in frame.collect()]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    order = [names.index(c) for c in sorted(names)]
    want = [tuple(norm(row[i]) for i in order) for row in cur.fetchall()]
    got.sort()
    want.sort()
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
    return f"{len(bad)} of {len(got)} differ, first {[p for p in zip(*bad[0], sorted(names)) if p[0] != p[1]]}" if bad else f"ok {len(got)}"
