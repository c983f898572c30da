"""Events in stretches against a fold over whole sessions."""

import random

import pytest

from tracklake.operators import tracks as T
from tracklake.params import EventParams


def folded(rows, p):
    """One decision after the other, as the machine is defined."""
    out = []
    for key in sorted({r[:2] for r in rows}):
        recent, negatives, held = [], 0, None
        for _, _, step, said, score, obj, mot, reason in sorted(r for r in rows if r[:2] == key):
            recent, negatives = [*recent, said][-p.n_on :], 0 if said else negatives + 1
            if held is None and sum(recent) >= p.k_on:
                held = [step, None, 0.0, 0.0, 0.0, []]
            if held and said:
                held[2:5] = max(held[2], score), max(held[3], obj), max(held[4], mot)
                held[5].append(reason)
            if held and negatives >= p.m_off:
                out.append((*key, held[0], step, *held[2:5], sorted(held[5])))
                held = None
        if held:
            out.append((*key, *held[:5], sorted(held[5])))
    return sorted(out, key=lambda r: r[:3])


@pytest.mark.parametrize(("n_on", "k_on", "m_off"), [(4, 2, 5), (1, 1, 1), (3, 3, 2), (6, 1, 3), (5, 2, 9)])
def test_stretches_of_any_length(spark, n_on, k_on, m_off):
    rnd = random.Random(n_on * 100 + m_off)
    p, rows = EventParams(n_on, k_on, m_off), []
    for track in range(7):
        step, likely = rnd.randrange(30), 0.5
        for _ in range(rnd.choice((1, 3, 60, 300))):
            if rnd.random() < 0.1:
                likely = rnd.choice((0.02, 0.3, 0.9))
            said = rnd.random() < likely
            rows.append((track, track % 2, step, said, *(round(rnd.random(), 3) for _ in range(3)), rnd.choice(("object", "motion", "object+motion")) if said else ""))
            step += rnd.choice((1, 1, 6, 6, 40))
    table = spark.createDataFrame(rows, "track long, session long, step long, decision boolean, score double, obj_score double, mot_score double, reason string").repartition(3)
    want = folded(rows, p)
    for chunk in (7, 100, 1_000_000):
        got = sorted(((r.track, r.session, r.start_step, r.end_step, r.peak_score, r.peak_object, r.peak_motion, sorted(k for k, n in r.triggered_by.items() for _ in range(n))) for r in T.events(table, p, chunk=chunk).collect()), key=lambda r: r[:3])
        assert got == want, chunk
    assert [r.start_step for r in T.events(table, p, ordered=True).collect()] == sorted(r[2] for r in want)
    assert T.events(table.limit(0), p).count() == 0
