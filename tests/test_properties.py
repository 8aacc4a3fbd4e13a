"""Pre-aggregated operators == literal row-by-row rules, on random inputs."""

import random
from collections import Counter, defaultdict

import pytest

from tallyfold.operators.merge import drop_placeholders
from tallyfold.plans import jobs

from conftest import rows


def placeholder_rule(facts, token="-"):
    """The rule as written: count per group, filter, recount, filter, distinct."""
    def by_group(rs):
        g = defaultdict(list)
        for r in rs:
            g[(r[0], r[1], r[2])].append(r)
        return g
    step1 = [r for g in by_group(facts).values() for r in g if len(g) == 1 or r[4] not in (token, None)]
    step2 = [r for g in by_group(step1).values() for r in g if len(g) == 1 or r[3] not in (token, None)]
    return sorted({(r[0], r[1], r[2], r[4]) for r in step2}, key=lambda t: tuple((x is not None, x) for x in t))


@pytest.mark.parametrize("seed", range(4))
def test_drop_placeholders_equals_rule(spark, seed):
    rng = random.Random(seed)
    facts = []
    for _ in range(300):
        row = (rng.choice(["u1", "u2", "u3", None]), rng.choice(["N1", "N2"]), rng.choice(["m1", "m2"]),
               rng.choice(["-", "A", "B", None]), rng.choice(["-", "1", "x", None]))
        facts += [row] * rng.choice([1, 1, 1, 2, 3])
    df = spark.createDataFrame(facts, "ubigeo string, name string, fecha string, modal string, value string")
    got = rows(drop_placeholders(df, ["ubigeo", "name", "fecha"]), "ubigeo", "name", "fecha", "value")
    assert got == placeholder_rule(facts)


@pytest.mark.parametrize("seed", range(3))
def test_at_local_equals_rule(spark, seed):
    rng = random.Random(seed)
    import datetime as dt
    tidy, decisions = [], []
    for n in range(1, 120):
        day = dt.date(1996, rng.choice([8, 9, 10]), rng.randint(1, 28))
        resp = rng.choice(["DIRECCION", "1-URGENT", "2-HIGH"])
        tidy.append((n, day, rng.choice(["AT_GL", "AT_PPSS"]), resp, rng.choice(["F", "O", "P", None])))
        for code in rng.sample(["01", "02", "03"], rng.choice([1, 1, 2])):
            decisions.append((n, code, rng.choice(["OK", "OK", "NO", None, "04"])))
    t = spark.createDataFrame(tidy, "n_row long, event_date date, category string, responsible string, mode string")
    d = spark.createDataFrame(decisions, "n_row long, ubigeo string, decision string")
    got = rows(jobs.at_local(t, d), "ubigeo", "name", "fecha", "modal", "value")

    by_row = {r[0]: r for r in tidy}
    acc = {(c if v == "OK" else v, n) for n, c, v in decisions if v is not None and v != "NO"}
    joined = []
    for code, n in acc:
        _, day, cat, resp, mode = by_row[n]
        typ = "CE" if resp == "DIRECCION" else "PPSS"
        joined.append((code, n, cat, day.strftime("%m%Y"), typ, mode, resp))
    modes = defaultdict(set)
    for code, n, cat, f, typ, mode, resp in joined:
        if mode is not None:
            modes[(code, f)].add(mode)
    first = {}
    for r in joined:
        k = (r[0], r[2], r[4], r[3])
        if k not in first or r[1] < first[k][1]:
            first[k] = r
    want = sorted((r[0], r[2], r[3], " y ".join(sorted(modes[(r[0], r[3])])), r[6]) for r in first.values())
    assert got == want
