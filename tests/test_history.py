"""Attribute history and snapshot changes against a plain sequential model."""

import hashlib
import random
import unicodedata

import pytest

from pageatlas.operators.history import attribute_history
from pageatlas.operators.snapshots import changes_between_days

PEOPLE = "person_id string, name string, url string, city string, state string, country string, valid_from string, valid_to string, attrs string, k string, owner string"
SNAPS = "snapshot_date string, name string, city string, state string, country string, created string, updated string, checked string, url string, delivery bigint, line_no bigint, day string, place string"


def value(x):
    return unicodedata.normalize("NFC", " ".join((x or "").split()))


def place(n, c):
    return tuple(unicodedata.normalize("NFC", value(v).casefold()) for v in (n, c))


def model(people, snaps):
    last = {}
    for r in snaps:
        last[r[0]] = max(last.get(r[0], -1), -1 if r[9] is None else r[9])
    days = sorted(d for d in last if d is not None)
    recs = {d: {} for d in days}
    for r in sorted(set(snaps), key=lambda r: 2**62 if r[10] is None else r[10]):
        if r[0] is None or (-1 if r[9] is None else r[9]) != last[r[0]] or r[8] is None:
            continue
        u = r[8].strip()
        if u.startswith(("http://", "https://")):
            recs[r[0]].setdefault(u, (tuple(map(value, r[1:5])), place(r[1], r[2]), r[10]))
    table = [[p[0], p[2].strip(), tuple(map(value, (p[1], p[3], p[4], p[5]))), place(p[1], p[3]), p[6], p[7] or ""] for p in sorted(set(people), key=lambda p: (p[6], p[2]))]
    changes, before = [], None
    for d in days:
        cur = recs[d]
        if before is not None:
            changes += [(d, u, "added") for u in cur if u not in before] + [(d, u, "removed") for u in before if u not in cur]
            changes += [(d, u, "changed") for u in cur if u in before and cur[u][0] != before[u][0]]
        before = cur
        by_url, by_place = {}, {}
        for t in table:
            by_url[t[1]], by_place[t[3]] = t[0], t[0]
        open_ = {t[1]: t for t in table if t[5] == ""}
        changed, new = [], []
        for u, t in open_.items():
            if u not in cur:
                t[5] = d
            elif cur[u][0] != t[2]:
                t[5] = d
                changed.append((cur[u][2], [t[0], u, cur[u][0], cur[u][1], d, ""]))
        for u, c in cur.items():
            if u not in open_:
                pid = by_url.get(u) or by_place.get(c[1]) or "p_" + hashlib.sha1(u.encode()).hexdigest()[:12]
                new.append([pid, u, c[0], c[1], d, ""])
                by_place[c[1]] = pid
        table += [x for _, x in sorted(changed, key=lambda x: x[0])] + new
    return sorted((t[0], t[1], t[4], t[5]) for t in table), sorted(changes)


def world(seed, n_days=5, n_urls=14):
    rng = random.Random(seed)
    names, cities = ["Ann", "ANN", " Bo  Li", "José", "José", "Straße"], ["Rome", "rome ", "Ulm", None]
    urls = [f"https://u{i}.example/now" for i in range(n_urls)]
    people = []
    for u in urls[:4]:
        pid = "p_" + u[8:10]
        people.append((pid, rng.choice(names), u, rng.choice(cities), None, "X", "2024-01-01", "2024-02-01" if u == urls[0] else None, "a", "k", "o"))
    people += people[:2]
    snaps = []
    for k in range(n_days):
        day = f"2025-01-{k + 1:02d}"
        for delivery in (1, 2) if rng.random() < 0.3 else (1,):
            for line, u in enumerate(rng.sample(urls, rng.randint(5, n_urls))):
                odd = rng.random()
                u = f" {u} " if odd < 0.1 else "ftp://no" if odd < 0.15 else None if odd < 0.18 else u
                row = (day, rng.choice(names), rng.choice(cities), rng.choice(["", None]), "X", "", "", "", u, delivery, line, "clash", "clash")
                snaps += [row] * (2 if rng.random() < 0.2 else 1)
                if rng.random() < 0.2:
                    snaps.append((day, "Other", "Ulm", None, "X", "", "", "", u, delivery, line + 100, "clash", "clash"))
    rng.shuffle(snaps)
    return people, snaps


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_history_and_changes_equal_the_sequential_model(spark, seed):
    people, snaps = world(seed)
    want, changes = model(people, snaps)
    p, s = spark.createDataFrame(people, PEOPLE), spark.createDataFrame(snaps, SNAPS)
    got = sorted(map(tuple, attribute_history(p, s).select("person_id", "url", "valid_from", "valid_to").collect()))
    assert got == want
    assert sorted(map(tuple, changes_between_days(s).collect())) == changes


def test_empty_tables(spark):
    p, s = spark.createDataFrame([], PEOPLE), spark.createDataFrame([], SNAPS)
    assert attribute_history(p, s).count() == 0
    assert changes_between_days(s).count() == 0
    people, snaps = world(4, n_days=1)
    assert attribute_history(spark.createDataFrame(people, PEOPLE), s).count() == len(set(people))
    first = attribute_history(p, spark.createDataFrame(snaps, SNAPS))
    assert {r["valid_to"] for r in first.collect()} == {""}


def test_null_day_and_null_numbers(spark):
    rows = [(None, "a", "b", None, None, None, None, None, "https://x.example", 1, 1, "", ""), ("2025-01-01", None, None, None, None, None, None, None, "https://x.example", None, None, "", ""),
            ("2025-01-02", "", "", "", "", None, None, None, "https://x.example", None, 3, "", "")]
    s = spark.createDataFrame(rows, SNAPS)
    assert changes_between_days(s).count() == 0  # null and empty are the same value


def test_crowded_place_is_scanned_in_chunks(spark, monkeypatch):
    from pageatlas.operators import history

    monkeypatch.setattr(history, "SCAN_LINES", 3)
    people, snaps = world(5)
    snaps = [(r[0], "Ann", "Rome", *r[3:]) for r in snaps]
    want, _ = model(people, snaps)
    got = attribute_history(spark.createDataFrame(people, PEOPLE), spark.createDataFrame(snaps, SNAPS))
    assert sorted(map(tuple, got.select("person_id", "url", "valid_from", "valid_to").collect())) == want
