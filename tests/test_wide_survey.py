"""End-to-end on a wide survey CSV: header-derived schema, hundreds of
activity columns, prefix groups, buckets, hours and grouped averages,
checked against a brute-force computation in Python."""

import random

import pytest

from quarry.plans import time_usage as TU
from quarry.sources.csv import read_headed_csv

CODES = ["teage", "telfs", "tesex", "tuyear"]
# Activity columns by rule: every two-digit major code 01..18 and 50, with
# minor codes, so every prefix group (and the unmatched t50) is populated.
ACTIVITY = [f"t{major:02d}{minor:02d}{k:02d}" for major in list(range(1, 19)) + [50]
            for minor in (1, 2, 3, 5, 99) for k in (1, 2, 3, 4)]


def brute(rows, names):
    groups = {g: [n for n in names if any(n.startswith(p) for p in ps) and
                  not any(n.startswith(q) for g2, qs in TU.ACTIVITY_GROUPS[:i] for q in qs)]
              for i, (g, ps) in enumerate(TU.ACTIVITY_GROUPS)}
    out = []
    for r in rows:
        v = dict(zip(names, r))
        if v["telfs"] > 4:
            continue
        working = "working" if 1 <= v["telfs"] < 3 else "not working"
        sex = "male" if v["tesex"] == 1 else "female"
        a = v["teage"]
        age = "young" if 15 <= a <= 22 else "active" if 23 <= a <= 55 else "elder"
        out.append((working, sex, age, *[sum(v[c] for c in groups[g]) / 60 for g, _ in TU.ACTIVITY_GROUPS]))
    return out


@pytest.fixture(scope="module")
def wide_csv(tmp_path_factory):
    rnd = random.Random(7)
    names = ["tucaseid"] + CODES + ACTIVITY
    rows = []
    for i in range(60):
        rows.append([f'"2003{i:010d}"', rnd.randint(10, 80), rnd.randint(1, 5), rnd.randint(1, 2), 2003]
                    + [rnd.choice([0, 0, 0, 15, 30, 60, 120]) for _ in ACTIVITY])
    p = tmp_path_factory.mktemp("wide") / "survey.csv"
    p.write_text(",".join(names) + "\n" + "\n".join(",".join(map(str, r)) for r in rows) + "\n")
    return str(p), names, [[r[0].strip('"')] + [float(x) for x in r[1:]] for r in rows]


def test_wide_summary_and_grouped(spark, wide_csv):
    path, names, rows = wide_csv
    cols, df = read_headed_csv(spark, path)
    assert cols == names and len(df.columns) == len(names)
    groups = TU.classified_columns(cols)
    assert all(len(v) > 0 for v in groups.values())
    assert not any(c.startswith("t50") for v in groups.values() for c in v)
    got = sorted(tuple(r) for r in TU.time_usage_summary(df).collect())
    exp = sorted(brute([r[1:] for r in rows], names[1:]))
    assert len(got) == len(exp)
    for g, e in zip(got, exp):
        assert g[:3] == e[:3] and g[3:] == pytest.approx(e[3:])
    grouped = TU.time_usage_grouped(TU.time_usage_summary(df)).collect()
    keys = [tuple(r[:3]) for r in grouped]
    assert keys == sorted(set(k[:3] for k in exp))


def test_no_work_columns(spark, wide_csv, tmp_path):
    path, names, rows = wide_csv
    keep = [i for i, n in enumerate(names) if not n.startswith(("t05", "t1805"))]
    p = tmp_path / "narrow.csv"
    lines = [",".join(names[i] for i in keep)]
    for r in rows:
        lines.append(",".join(str(r[i]) for i in keep))
    p.write_text("\n".join(lines) + "\n")
    _, df = read_headed_csv(spark, str(p))
    assert {r.work for r in TU.time_usage_summary(df).collect()} == {0.0}
