"""Linking of credential parts against all pairs, and its cost."""

import random

from bazaarlens.llm import secrets as S

DDL = "row bigint, doc_id bigint, kind int, start int, end int"


def plain_links(parts, reach):
    """(row, kind, start, end) of the reported parts, over all pairs of a row."""
    info = {v[2]: (v[3], v[4]) for v in S.KINDS.values()}
    out = set()
    for p in parts:
        if p[2] is None:
            continue
        others = [q for q in parts if q[0] == p[0] and q[2] is not None and q != p]
        role, strong = info[p[2]]
        need = "IE" if role == "S" else "S"
        near = any(info[q[2]][0] in need and q[3] - p[4] <= reach and p[3] - q[4] <= reach
                   for q in others)
        covered = any(info[q[2]][1] and q[3] < p[4] and q[4] > p[3] for q in others)
        if strong or (near and not covered):
            out.add((p[0], p[2], p[3], p[4]))
    return out


def random_parts(rnd, rows, n):
    """Parts of a kind do not overlap; parts of different kinds may."""
    out = []
    for row in range(rows):
        for kind in range(6):
            at = rnd.randrange(300)
            for _ in range(rnd.randrange(n)):
                size = rnd.randrange(6, 60)
                out.append((row, row, kind if rnd.random() < 0.9 else None, at, at + size))
                at += size + rnd.randrange(1, 900)
    return out


def test_links_match_all_pairs(spark):
    parts = random_parts(random.Random(5), 30, 9)
    got = {(r.row, r.kind, r.start, r.end)
           for r in S.link_parts(spark.createDataFrame(parts, DDL)).filter("reported").collect()}
    assert got == plain_links(parts, S.REACH)


def test_no_frame_is_open_to_the_right(spark):
    """Spark computes such a frame anew for every row: quadratic in a text's parts."""
    linked = S.link_parts(spark.createDataFrame([(1, 1, 0, 0, 9)], DDL))
    plan = linked._jdf.queryExecution().executedPlan().toString().lower()
    assert "unboundedpreceding" in plan and "unboundedfollowing" not in plan
