import datetime as dt
import random

import pytest

from sparkledger.operators import align_events

SENT = dt.datetime(4000, 12, 31)
AS_OF = dt.datetime(2024, 6, 1)
D0 = dt.datetime(2024, 1, 1)


def brute_force(events, periods, as_of=AS_OF):
    """Plain loops over the rules: cut-off per asset, k-th/k-th pairing,
    surplus dropped, the rest moved to the placeholder, last one per id kept."""
    by_asset = {}
    for p in periods:
        by_asset.setdefault(p[1], []).append(p)

    def newest_first(d):
        return (d is not None, -(d - D0).total_seconds() if d is not None else 0)

    cut = {}
    for a, ps in by_asset.items():
        ps = sorted(ps, key=lambda p: (newest_first(p[2]), -p[0]))
        base = ps[1][2] if len(ps) > 1 else as_of
        cut[a] = None if base is None else base + dt.timedelta(weeks=2)

    def cut_of(a):
        return cut[a] if a in cut else as_of + dt.timedelta(weeks=2)

    matched, dropped = {}, set()
    for a in {e[1] for e in events if e[1] is not None}:
        c = cut_of(a)
        el = [e for e in events if e[1] == a and e[2] is not None and c is not None and e[2] <= c]
        el.sort(key=lambda e: (newest_first(e[2]), e[0]))
        pe = [p for p in by_asset.get(a, []) if p[2] is not None and c is not None and p[2] <= c]
        pe.sort(key=lambda p: (newest_first(p[2]), -p[0]))
        n = min(len(el), len(pe))
        for i in range(n):
            matched[el[i][0]] = pe[i][0]
        dropped |= {e[0] for e in el[n:]}
    placeholder = {}
    for p in periods:
        if p[2] == SENT:
            placeholder[p[1]] = max(placeholder.get(p[1], p[0]), p[0])
    good, rejects = {}, []
    for e in events:
        if e[0] in dropped:
            continue
        rid = matched.get(e[0])
        when = e[2] if rid is not None else SENT
        if when == SENT and e[1] in placeholder:
            rid = placeholder[e[1]]
        if rid is None:
            rejects.append(e[0])
            continue
        good.setdefault(rid, []).append(e)
    kept = {}
    for rid, es in good.items():
        es.sort(key=lambda e: (e[2] is None, e[2] or D0, -e[0]))
        kept[rid] = es[0][0]
    return kept, sorted(rejects)


def random_case(seed):
    rnd = random.Random(seed)
    periods, events = [], []
    pid = 1
    for a in range(6):
        for _ in range(rnd.randint(0, 6)):
            d = None if rnd.random() < 0.1 else D0 + dt.timedelta(days=rnd.randint(0, 120))
            periods.append((pid, a, d))
            pid += 1
        if rnd.random() < 0.7:
            periods.append((pid, a, SENT))
            pid += 1
    eid = 1
    for a in list(range(7)) + [None]:
        for _ in range(rnd.randint(0, 9)):
            d = None if rnd.random() < 0.1 else D0 + dt.timedelta(days=rnd.choice([0, 10, 20, 40, 80, 100, 130, 160]))
            events.append((eid, a, d))
            eid += 1
    return events, periods


def run(spark, events, periods, small_groups=True):
    ev = spark.createDataFrame(events, "eid long, asset_id long, accepted_date timestamp")
    pr = spark.createDataFrame(periods, "id long, asset_id long, accepted_date timestamp")
    aligned, rejects = align_events(ev, pr, as_of=AS_OF, tiebreak=["eid"], small_groups=small_groups)
    kept = {r.reporting_period_id: r.eid for r in aligned.collect()}
    return kept, sorted(r.eid for r in rejects.collect())


@pytest.mark.parametrize("seed", range(6))
def test_align_matches_brute_force(spark, seed):
    events, periods = random_case(seed)
    assert run(spark, events, periods) == brute_force(events, periods)


@pytest.mark.parametrize("seed", [1, 3])
def test_align_range_path_matches_brute_force(spark, seed):
    """Ranks spread over range partitions, the default where groups are not bounded."""
    events, periods = random_case(seed)
    assert run(spark, events, periods, small_groups=False) == brute_force(events, periods)


def test_align_basic_story(spark):
    # Asset 1: periods Jan, Apr, placeholder; earnings Jan 5, Apr 3, Jul 1 (estimate), Oct 1 (estimate).
    periods = [(10, 1, dt.datetime(2024, 1, 2)), (11, 1, dt.datetime(2024, 4, 1)), (99, 1, SENT)]
    events = [(1, 1, dt.datetime(2024, 1, 5)), (2, 1, dt.datetime(2024, 4, 3)),
              (3, 1, dt.datetime(2024, 7, 1)), (4, 1, dt.datetime(2024, 10, 1))]
    kept, rejects = run(spark, events, periods)
    # Apr 3 <= Apr 1 + 2 weeks pairs with the newest period, Jan 5 with the older;
    # the two estimates share the placeholder and the nearer (Jul 1) survives.
    assert kept == {11: 2, 10: 1, 99: 3}
    assert rejects == []
    assert (kept, rejects) == brute_force(events, periods)


def test_align_without_placeholder_rejects_future(spark):
    periods = [(10, 1, dt.datetime(2024, 1, 2))]
    events = [(1, 1, dt.datetime(2024, 1, 5)), (2, 1, dt.datetime(2024, 9, 1))]
    kept, rejects = run(spark, events, periods)
    assert (kept, rejects) == brute_force(events, periods)
    assert rejects == [2]


def dts(*days):
    return [D0 + dt.timedelta(days=d) for d in days]


@pytest.mark.parametrize("n_events", [2, 3, 4])
def test_align_event_list_shorter_equal_longer(spark, n_events):
    # Three reported periods plus a placeholder; cut-off = newest report + 2 weeks.
    periods = [(10 + i, 1, d) for i, d in enumerate(dts(0, 90, 180))] + [(99, 1, SENT)]
    events = [(i + 1, 1, d) for i, d in enumerate(dts(185, 95, 5, -85)[:n_events])]
    kept, rejects = run(spark, events, periods)
    assert (kept, rejects) == brute_force(events, periods)
    # newest event pairs with the newest period, and so on down the list
    assert kept[12] == 1 and kept[11] == 2
    assert (10 in kept) == (n_events >= 3)
    assert 99 not in kept            # no estimates: the placeholder stays unused


def test_align_single_period_and_two_estimates(spark):
    periods = [(10, 1, dts(0)[0]), (99, 1, SENT)]
    events = [(1, 1, dts(3)[0]), (2, 1, dts(200)[0]), (3, 1, dts(100)[0])]
    kept, rejects = run(spark, events, periods)
    assert kept == {10: 1, 99: 3}    # the nearer of the two estimates survives
    assert (kept, rejects) == brute_force(events, periods)


def test_align_tied_dates(spark):
    periods = [(10, 1, dts(0)[0]), (11, 1, dts(0)[0]), (99, 1, SENT)]
    events = [(1, 1, dts(1)[0]), (2, 1, dts(1)[0])]
    assert run(spark, events, periods) == brute_force(events, periods)
