import random
from datetime import date, timedelta

from conftest import day

from carestrata.operators import windows

FAR = date(9999, 12, 31)
SCHEMAS = {
    "targets": "study string, target_id int, subject_id long, index_date date, end_date date",
    "outcomes": "study string, outcome_id int, subject_id long, outcome_date date",
    "outcome_ids": "study string, outcome_id int",
    "periods": "person_id long, observation_period_start_date date, observation_period_end_date date",
    "deaths": "person_id long, death_date date",
    "settings": "study string, prior_days int, washout_days int, risk_start int, risk_end int, risk_from_end boolean, censor_at_outcome boolean",
}


def moved(d, days):
    return d + timedelta(days=min(days, (FAR - d).days))


def brute(targets, outcomes, outcome_ids, periods, deaths, settings):
    joined = {}
    for person in {p for p, *_ in periods}:
        spans = []
        for start, end in sorted((s, e or FAR) for p, s, e in periods if p == person and s and (e or FAR) >= s):
            if spans and (start - spans[-1][1]).days <= 1:
                spans[-1][1] = max(spans[-1][1], end)
            else:
                spans.append([start, end])
        joined[person] = spans
    rules = {s: rest for s, *rest in settings}
    rows = {}
    for study, target, subject, index, end in targets:
        if index is not None:
            rows.setdefault((study, target, subject, index), []).append(end)
    out = []
    for (study, target, subject, index), ends in rows.items():
        if study not in rules:
            continue
        prior_days, washout, start, stop, from_end, censor = rules[study]
        span = next((s for s in joined.get(subject, []) if s[0] <= index <= s[1]), None)
        died = min((d for p, d in deaths if p == subject and d), default=FAR)
        observed = min(span[1] if span else FAR, died)
        end = None if None in ends else max(ends)
        row_end = max(index, end or (span[1] if span else index))
        risk_start = moved(index, start or 0)
        planned = observed if stop is None else moved(row_end if from_end else index, stop)
        risk_end = min(planned, observed)
        for outcome in sorted({o for s, o in outcome_ids if s == study}):
            days = [d for s, o, p, d in outcomes if (s, o, p) == (study, outcome, subject) and d]
            last = max((d for d in days if d < index), default=None)
            hit = min((d for d in days if risk_start <= d <= risk_end), default=None)
            if span is None or index > observed:
                status = "not observed"
            elif (index - span[0]).days < (prior_days or 0):
                status = "short prior observation"
            elif last and (washout is None or (index - last).days <= washout):
                status = "prior outcome"
            elif risk_start > risk_end:
                status = "no time at risk"
            else:
                status = "case" if hit else "no case"
            counts = status in ("case", "no case")
            close = min(risk_end, hit) if censor and hit else risk_end
            out.append((
                study, target, subject, index, outcome, (index - span[0]).days if span else None, last,
                *((risk_start, risk_end, hit, (close - risk_start).days + 1) if counts else (None, None, None, 0)), status,
            ))
    return out


def check(spark, **tables):
    frames = {n: spark.createDataFrame(rows, SCHEMAS[n]).repartition(4) for n, rows in tables.items()}
    got = [tuple(r) for r in windows.cohort_windows(**frames).collect()]
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(got, key=key) == sorted(brute(**tables), key=key)
    return got


def test_equals_brute_force_with_a_hot_person(spark):
    """Null and far ends, overlapping periods, deaths, and one person with a third of all rows."""
    draw = random.Random(5)
    any_day = lambda: day("2020-01-01") + timedelta(days=draw.randint(0, 300))
    person = lambda: 1 if draw.random() < 0.34 else draw.randint(2, 40)
    studies = ["a", "b", "c", "d"]
    targets = [(draw.choice([*studies, "none"]), 1, person(), draw.choice([any_day(), any_day(), None]), draw.choice([any_day(), None, FAR])) for _ in range(400)]
    outcomes = [(draw.choice(studies), draw.choice([2, 3]), person(), draw.choice([any_day(), any_day(), any_day(), None])) for _ in range(400)]
    periods = [(p, any_day(), draw.choice([any_day(), any_day(), None, FAR])) for p in range(1, 38) for _ in range(draw.randint(1, 3))]
    settings = [("a", 30, 60, 1, 90, False, True), ("b", None, None, 0, None, None, False), ("c", 0, 0, 5, 3, True, True), ("d", 10, 365, None, 9_000_000, False, None)]
    got = check(
        spark, targets=targets, outcomes=outcomes, outcome_ids=[(s, o) for s in studies for o in (2, 3, 2)],
        periods=periods, deaths=[(p, draw.choice([any_day(), None])) for p in range(1, 20)], settings=settings,
    )
    assert len({r[-1] for r in got}) == 6


def test_worked_example(spark):
    base = {
        "outcomes": [("s", 2, 1, day("2020-03-01")), ("s", 2, 1, day("2020-06-20"))],
        "outcome_ids": [("s", 2)],
        "periods": [(1, day("2019-01-01"), None)],
        "deaths": [(1, day("2020-07-01"))],
        "settings": [("s", 365, 90, 1, 90, False, True)],
    }
    dates = {r[3]: r for r in check(spark, targets=[("s", 1, 1, day(d), None) for d in ("2019-12-31", "2020-04-01", "2020-06-10", "2020-07-02")], **base)}
    assert dates[day("2019-12-31")][-1] == "short prior observation"
    assert dates[day("2020-04-01")][-1] == "prior outcome"
    assert dates[day("2020-06-10")][7:] == (day("2020-06-11"), day("2020-07-01"), day("2020-06-20"), 10, "case")
    assert dates[day("2020-07-02")][-1] == "not observed"


def test_empty_tables(spark):
    frames = {n: spark.createDataFrame([], s) for n, s in SCHEMAS.items()}
    assert windows.incidence(windows.cohort_windows(**frames)).count() == 0
