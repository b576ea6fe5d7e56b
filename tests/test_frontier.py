"""The frontier of a crawl against a plain simulation."""

import random

from touchline.operators import frontier

PAGE = "host string, url string, priority int, tries int, failed_at double"
NOW = 1000.0


def simulated(pages, landed, gap):
    """Each host on its own: the page that is ready first, then a pause."""
    best = {}
    for host, url, priority, tries, failed in pages:
        if url is not None and url not in landed:
            old = best.get((host, url), (None, None, None))
            most = lambda a, b: b if a is None else a if b is None else max(a, b)
            best[host, url] = tuple(map(most, old, (priority, tries, failed)))
    out, clock, place = [], {}, {}
    rows = []
    for (host, url), (priority, tries, failed) in best.items():
        ready = NOW if not tries else max(NOW, (NOW if failed is None else failed) + min(30.0 * 2 ** (tries - 1), 86_400.0))
        rows.append((ready, priority is None, -(priority or 0), url, host))
    for ready, _, _, url, host in sorted(rows, key=lambda x: x[:4]):
        at = max(ready, clock[host] + gap) if host in clock else ready
        clock[host], place[host] = at, place.get(host, -1) + 1
        out.append((host, url, place[host], at))
    return sorted(out, key=str)


def test_equals_a_simulation(spark):
    r = random.Random(6)
    pages = [
        (r.choice([None, "a", "b", "c"]), r.choice([None, *(f"u{i}" for i in range(150))]), r.choice([None, 1, 2, 5]), r.choice([None, 0, 0, 1, 2, 12]),
         r.choice([None, *(NOW - x for x in (5.0, 31.5, 200.0))]))
        for _ in range(400)
    ]
    landed = {f"u{i}" for i in range(0, 150, 4)}
    df, done = spark.createDataFrame(pages, PAGE), spark.createDataFrame([(u,) for u in landed], "url string")
    for gap in (1.0, 2.5):
        got = sorted(map(tuple, frontier.schedule(df, done, NOW, gap).collect()), key=str)
        want = simulated(pages, landed, gap)
        assert [x[:3] for x in got] == [x[:3] for x in want] and all(abs(a[3] - b[3]) < 1e-6 for a, b in zip(got, want))
        times = {}
        for host, _, _, at in got:
            times.setdefault(host, []).append(at)
        assert all(b - a >= gap - 1e-6 for t in times.values() for a, b in zip(sorted(t), sorted(t)[1:]))
    near = frontier.schedule(df, done, NOW, 1.0, horizon=10.0).collect()
    assert near and {(x.host, x.url) for x in near} == {x[:2] for x in simulated(pages, landed, 1.0) if x[3] <= NOW + 10}


def test_no_pages(spark):
    none = spark.createDataFrame([], PAGE)
    assert frontier.schedule(none, none.select("url"), NOW).count() == 0
