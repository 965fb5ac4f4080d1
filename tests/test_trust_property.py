"""The whole trust stage against a plain-Python model of its rules, on
generated CSV batch files: header layouts (order, case, blanks, extras,
missing and repeated names), empty cells, identical copies, conflicting
versions, NULL keys and text that does or does not convert."""

import json
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from trustfold.operators.contracts import Contract
from trustfold.operators.quarantine import Run
from trustfold.plans.trusted import build_trusted

CONTRACT = Contract(columns=("id", "tenure", "charges"), key="id", types={"tenure": "int", "charges": "double"})
RUN = Run(run_id="run-p", started_at="2026-08-03T10:00:00Z")

# header cell spellings per column (all normalise to the column) and extras
SPELLINGS = {"id": ["id", "ID", " Id "], "tenure": ["tenure", "TENURE", " Tenure"],
             "charges": ["charges", "Charges ", "CHARGES"]}
VALUES = {"id": ["k1", "k2", "k3", ""], "tenure": ["1", "5.7", " 3 ", "abc", "", ".5", "-2"],
          "charges": ["2.5", "x", "", "1e3", " 4 ", "-0.5"], "extra": ["e", ""]}


def _int_legacy(v):
    if v is None:
        return None
    t = v.strip(" ")
    if not re.fullmatch(r"[+-]?[0-9]*(\.[0-9]*)?", t) or re.fullmatch(r"[+-]?", t):
        return None
    whole = re.match(r"[+-]?[0-9]*", t).group(0)
    n = 0 if re.fullmatch(r"[+-]?", whole) else int(whole)
    return n if -2**31 <= n < 2**31 else None


def _double(v):
    try:
        return None if v is None else float(v)
    except ValueError:
        return None


@st.composite
def batch_file(draw):
    cols = draw(st.permutations(["id", "tenure", "charges", "extra"]))
    cols = [c for c in cols if c == "id" or c == "extra" or draw(st.booleans()) or draw(st.booleans())]
    header = [draw(st.sampled_from(SPELLINGS[c])) if c in SPELLINGS else "extra" for c in cols]
    if draw(st.integers(0, 9)) == 0:  # a repeated name
        header.append(draw(st.sampled_from(SPELLINGS["tenure"])))
        cols.append("tenure")
    rows = draw(st.lists(st.tuples(*[st.sampled_from(VALUES[c]) for c in cols]), max_size=8))
    rows = rows + draw(st.lists(st.sampled_from(rows), max_size=3)) if rows else rows  # identical copies
    return header, cols, rows


def _model(files):
    """files: list of (name, header, cols, rows) -> (trusted set, rejects set)."""
    trusted, rejects = set(), set()
    for name, header, cols, rows in files:
        norm = [h.strip().lower() for h in header]
        errs = []
        for n in dict.fromkeys(norm):
            if norm.count(n) > 1:
                errs.append(("repeated_header", None))
        for c in CONTRACT.columns:
            if c not in norm:
                errs.append(("missing_column", None))
        if errs:
            rejects |= {(name, rule, None, None) for rule, _ in errs}
            continue
        recs = set()
        for r in rows:
            cell = dict(zip(cols, r))
            recs.add(tuple((cell[c] if cell[c] != "" else None) for c in CONTRACT.columns))
        versions = {}
        for rec in recs:
            versions[rec[0]] = versions.get(rec[0], 0) + 1
        for rec in recs:
            payload = json.dumps(dict(zip(CONTRACT.columns, rec)), separators=(",", ":"))
            if versions[rec[0]] > 1:
                rejects.add((name, "conflicting_duplicate_key", rec[0], payload))
                continue
            t, c = _int_legacy(rec[1]), _double(rec[2])
            if t is None:
                rejects.add((name, "not_numeric_tenure", rec[0], payload))
            if c is None:
                rejects.add((name, "not_numeric_charges", rec[0], payload))
            if t is not None and c is not None:
                trusted.add((name, rec[0], t, c))
    return trusted, rejects


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture,
                                                                 HealthCheck.too_slow])
@given(batches=st.lists(batch_file(), min_size=1, max_size=3))
def test_trust_stage_matches_model(spark, tmp_path_factory, batches):
    d = tmp_path_factory.mktemp("batches")
    files, paths = [], []
    for i, (header, cols, rows) in enumerate(batches):
        p = d / f"b{i}.csv"
        p.write_text(",".join(header) + "\n" + "".join(",".join(r) + "\n" for r in rows), encoding="utf-8")
        files.append((f"b{i}.csv", header, cols, rows))
        paths.append(str(p))
    out = build_trusted(spark, paths, CONTRACT, RUN, scratch=str(d / "scratch"))
    got_t = {(r._source_file.rsplit("/", 1)[1], r.id, r.tenure, r.charges) for r in out.trusted.collect()}
    got_q = set()
    for r in out.quarantine.collect():
        name = r.source_file.rsplit("/", 1)[1]
        rec = None if r.record_key is None and r.rule in ("repeated_header", "missing_column") else r.original_record
        got_q.add((name, r.rule, r.record_key, rec))
    want_t, want_q = _model(files)
    assert got_t == want_t
    assert got_q == want_q
