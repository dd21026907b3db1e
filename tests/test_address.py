"""Address matching against a sequential brute force, and the state rules."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date, datetime

from cardloom.operators import address as a
from cardloom.operators import history as h
from tests.conftest import rows

AS_OF = datetime(2024, 3, 31, 4, 0, 0)
CANDIDATE = "FanID int, PostCode string, Address1 string, Address2 string, AddressOneNumber string, AddressTwoNumber string"
PAF = "Postcode string, BuildingNumber string, SubBuildingNumber string, SubBuildingName string, BuildingName string"


def digits(s):
    return None if s is None else "".join(c for c in s if c.isdigit())


def world(seed: int):
    rng = random.Random(seed)
    first = ["Flat 1", "Flat 2", "3 High St", "4 High St", "The Mill", "Garden Flat", "", None]
    second = ["3 High St", "4 High St", "Flat 1", "", None]
    cands = []
    for fan in range(60):
        for _ in range(rng.choice([1, 1, 1, 2])):
            one, two = rng.choice(first), rng.choice(second)
            cands.append((fan, rng.choice(["P1", "p2 ", "P3", None]), one, two, digits(one), digits(two)))
    paf = [
        (
            rng.choice(["P1", "P2", "P3", "P4"]),
            rng.choice(["3", "4", "", None]),
            rng.choice(["1", "2", "", None]),
            rng.choice(["FLAT 1", "Garden Flat", "", None]),
            rng.choice(["THE MILL", "the mill ", "", None]),
        )
        for _ in range(25)
    ]
    return cands, paf


def cascade(cands, paf):
    """Rule after rule; a rule sees only customers without a match so far."""
    key = lambda s: None if s is None else s.rstrip(" ").upper()
    eq = lambda x, y: x is not None and y is not None and key(x) == key(y)
    filled = lambda x: x is not None and x != ""
    rules = [
        lambda c, f: eq(f[1], c[5]) and eq(c[4], f[2]) and filled(c[5]),
        lambda c, f: eq(f[1], c[4]) and eq(c[5], f[2]) and filled(c[5]),
        lambda c, f: eq(f[1], c[4]) and filled(c[4]),
        lambda c, f: eq(f[1], c[5]) and eq(c[2], f[3]) and filled(c[5]),
        lambda c, f: eq(f[1], c[5]) and filled(c[5]),
        lambda c, f: eq(c[2], f[4]),
        lambda c, f: eq(c[2], f[3]),
    ]
    out, matched = [], set()
    for n, rule in enumerate(rules, start=1):
        hits = [
            (n, c[0], c[2], c[3], f[0], f[1], f[3], f[4])
            for c in cands
            for f in paf
            if c[0] not in matched and eq(c[1], f[0]) and rule(c, f)
        ]
        # Addresses that differ in case or trailing spaces are one, in the smallest spelling.
        alike: dict[tuple, list] = {}
        for h in hits:
            alike.setdefault((*h[:4], *map(key, h[4:])), []).append(h)
        least = lambda same: min(same, key=lambda h: [(x is not None, x or "") for x in h[4:]])
        out += [least(same) for same in alike.values() for _ in (same if n == a.KEEPS_REPEATS else [0])]
        matched |= {r[1] for r in hits}
    return out


def test_cascade_equals_the_sequential_rules(frame):
    found = 0
    for seed in range(4):
        cands, paf = world(seed)
        expected = cascade(cands, paf)
        per_fan = Counter(r[1] for r in expected)
        single = sorted((r for r in expected if per_fan[r[1]] == 1), key=repr)
        c, f = frame(CANDIDATE, *cands), frame(PAF, *paf)
        matches = a.cascade_match(c, f)
        assert rows(matches) == sorted(expected, key=repr)
        assert rows(a.drop_ambiguous(matches)) == single
        assert rows(a.match_unambiguous(c, f)) == single
        found += len(single)
    assert found > 10


def test_spellings_of_one_address_are_one_match(frame):
    cands = frame(CANDIDATE, (1, "P1", "3 High St", "", "3", ""), (2, "P1", "Old Mill", None, "", None))
    paf = frame(PAF, ("P1", "3", "", "Flat", ""), ("p1 ", "3", "", "FLAT ", ""), ("P1", "9", "", None, "old mill"), ("P1", "9", "", None, "OLD MILL"))
    matches = a.cascade_match(cands, paf)
    assert [r["FanID"] for r in matches.orderBy("FanID").collect()] == [1, 2, 2]  # the sixth rule counts rows
    assert rows(a.drop_ambiguous(matches)) == rows(a.match_unambiguous(cands, paf)) == [(3, 1, "3 High St", "", "P1", "3", "Flat", "")]


STATE = "FanID int, CINID int, microcell_id int, HashedAddress string, UnhashedAddress string, loadDate timestamp_ntz, isCurrentCohort int"
OLD, NEW = datetime(2024, 1, 1), datetime(2024, 2, 1)


def s(fan, cin, cohort, at=OLD, current=1):
    return (fan, cin, cohort, None, None, at, current)


def short(df):
    return sorted((r["FanID"], r["CINID"], r["microcell_id"], r["isCurrentCohort"]) for r in df.collect())


def test_unmatched_and_matched_rows(frame):
    state = frame(STATE, s(1, 1, -1), s(2, 2, 5))
    cands = frame("FanID int", (1,), (2,), (3,), (4,))
    details = frame("FanID int, SourceUID string, PostCode string", *[(i, f"S{i}", "P") for i in range(1, 5)])
    ids = frame("CIN string, CINID int", *[(f"S{i}", i) for i in range(1, 5)])
    matched = frame(
        "FanID int, microcell_id int, HashedAddress string, UnhashedAddress string, loadDate timestamp_ntz, isCurrentCohort int",
        (3, 8, "h", "u", AS_OF, 1),
        (3, 7, "h", "u", AS_OF, 1),
        (2, 5, "h", "u", AS_OF, 1),
    )
    grown = a.add_unmatched(state, cands, matched, details, ids, AS_OF)
    assert short(grown) == [(1, 1, -1, 1), (2, 2, 5, 1), (4, 4, -1, 1)]
    assert short(a.add_matched(grown, matched, details, ids)) == [(1, 1, -1, 1), (2, 2, 5, 1), (3, 3, 7, 1), (4, 4, -1, 1)]


def test_older_rows_expire(frame):
    state = frame(STATE, s(1, 1, 5), s(1, 1, 6, NEW), s(2, 2, 7), s(3, 3, 8, OLD, 0), s(None, 4, 9))
    got = {(r["FanID"], r["microcell_id"]): r["isCurrentCohort"] for r in a.expire_previous(state).collect()}
    assert got == {(1, 5): 0, (1, 6): 1, (2, 7): 1, (3, 8): 0, (None, 9): 1}


def test_duplicate_card_ids(frame):
    state = frame(STATE, s(1, 1, 5), s(2, 1, 6), s(3, 3, 5), s(3, 3, 6), s(4, 4, 1), s(2, 5, 1), s(None, 6, 1), s(6, 6, 2), s(7, None, 1), s(8, None, 2))
    kept = {(r["FanID"], r["CINID"]) for r in a.drop_duplicate_ids(state).collect()}
    assert kept == {(2, 1), (4, 4), (2, 5), (None, 6), (6, 6), (7, None), (8, None)}
    lower = a.drop_duplicate_ids(state, whole_customer=False)
    assert sorted((r["CINID"], r["microcell_id"]) for r in lower.where("CINID = 3").collect()) == [(3, 6)]


def test_postcode_default_changes_all_rows_of_the_card_id(frame):
    state = frame(STATE, s(1, 1, -1), s(1, 1, 5), s(2, 2, -1), s(3, 3, 5))
    details = frame("FanID int, SourceUID string, PostCode string", (1, "a", "ab1 "), (2, "b", "ZZ"), (3, "c", "AB1"))
    defaults = frame("Postcode_Trim string, cohort_ID int", ("AB1", 30), ("AB1", 20))
    assert short(a.apply_postcode_default(state, details, defaults)) == [(1, 1, 20, 1), (1, 1, 20, 1), (2, 2, -1, 1), (3, 3, 5, 1)]


def test_address_history(frame):
    at = lambda d: datetime(2024, 1, d)
    events = frame(
        "CustomerGUID string, CustomerAddress1 string, CustomerAddress2 string, CustomerAddress3 string, PostCode string,"
        " UpdatedAt timestamp_ntz, LoadDate timestamp_ntz",
        ("a", "old", None, None, "AB1 2CD", at(1), at(1)),
        ("a", "1", None, None, "AB1 2CD", at(2), at(10)),
        ("a", "1", None, None, "AB1 2CD", at(2), at(11)),
        ("a", "2", None, None, "AB1", at(3), at(12)),
        ("a", "3", None, None, " AB12C  ", at(4), at(13)),
        ("a", "4", None, None, "AB1 2CD", at(4), at(14)),
        ("a", "5", None, None, "AB1 2CD", None, at(15)),
        ("a", "6", None, None, "AB1 2CD", at(4), at(16)),
        ("b", "short only", None, None, "AB1", at(2), at(10)),
    )
    changed = h.changed_rows(events, date(2024, 1, 5))
    assert [r["CustomerAddress1"] for r in changed.orderBy("LoadDate").collect()] == ["1", "6"]
    intervals = h.validity_intervals(changed)
    assert [(r["CustomerAddress1"], r["NextUpdatedAt"]) for r in intervals.orderBy("LoadDate").collect()] == [("1", at(4)), ("6", None)]
    ids = frame("CIN string, CINID int", ("Sa", 1), ("Sb", 2), ("Sc", 3))
    external = h.external_id_map(frame("CustomerGUID string, ExternalID string, ExternalIDSource string", ("a", "Sa", "x"), ("b", "Sb", "y")), ["x"])
    pii = frame("CustomerGUID string, SourceUID string, Address1 string, Address2 string, PostCode string", ("a", "Sa", "-", "-", "P"), ("b", "Sb", "-", "-", "P"), ("c", "Sc", "now", "-", "P"))
    none, excluded = frame("SourceUID string, EndDate date"), frame("cinid int")
    history = h.history_rows(intervals, external, ids)
    base = h.base_events(events, date(2024, 1, 5))
    missing = h.missing_from_history(pii, ids, base, history, none, excluded)
    assert [r["CINID"] for r in missing.collect()] == [3]
    covered = h.missing_from_history(pii, ids, base, history, none, excluded, cover_short_postcodes=True)
    assert sorted(r["CINID"] for r in covered.collect()) == [2, 3]
    table = h.address_history(history, missing)
    assert sorted((r["CINID"], r["CustomerAddress1"]) for r in table.collect()) == [(1, "1"), (1, "6"), (3, "now")]
