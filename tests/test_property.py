"""Await routing against a literal two-pass model of the original algorithm (random inputs)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ingestflow.functions.timing import epoch_ms
from ingestflow.operators.reconcile import await_results
from ingestflow.schemas import HISTORY, PENDING

NOW = dt.datetime(2024, 6, 1)
NOW_MS = epoch_ms(NOW)
MIN = 60000
STATUSES = ["LOADED", "PARTIALLY_LOADED", "LOAD_FAILED", "LOAD_IN_PROGRESS"]


def jdiv(a, b):
    q = abs(a) // abs(b)
    return q if (a >= 0) == (b > 0) else -q


def model(pending, history, max_age):
    """Pass 1 builds the index and window; history fills it; pass 2 routes (in order)."""
    oldest, pipes, index = 1, set(), {}
    for (_rid, pipe, file, q, lineage, _seq) in pending:
        age = 0 if not q else jdiv(NOW_MS - int(q), MIN)
        if pipe is not None and file is not None:
            m = jdiv(NOW_MS - lineage, MIN)
            oldest = max(oldest, m)
            pipes.add(pipe)
            index.setdefault((pipe, file), {"age": age, "entry": None})
    then_ms = NOW_MS - abs(oldest) * MIN
    for h in sorted(history, key=lambda h: h[8]):        # response order = seq
        pipe, path, ts_ms = h[0], h[1], h[7]
        if pipe in pipes and then_ms <= ts_ms <= NOW_MS and (pipe, path) in index:
            index[(pipe, path)]["entry"] = h
    out = {}
    for (rid, pipe, file, q, _lineage, _seq) in pending:
        stamp = q if q else str(NOW_MS)
        if pipe is None:
            out[rid] = ("load_failure", stamp, "pipe")
            continue
        if file is None:
            out[rid] = ("load_failure", stamp, "file")
            continue
        r = index[(pipe, file)]
        e = r["entry"]
        if e is not None:
            st_ = e[2]
            route = {"LOADED": "loaded", "PARTIALLY_LOADED": "partially_loaded",
                     "LOAD_FAILED": "load_failure"}.get(st_, "waiting")
            err = e[6] if st_ in ("PARTIALLY_LOADED", "LOAD_FAILED") else None
            out[rid] = (route, stamp, err)
        elif max_age < r["age"]:
            out[rid] = ("unmatched", None, None)
        else:
            out[rid] = ("waiting", stamp, None)
    return out


key = st.sampled_from(["a", "b", "c"])
pending_row = st.tuples(st.one_of(st.none(), st.sampled_from(["p", "q"])), st.one_of(st.none(), key),
                        st.one_of(st.just(""), st.none(), st.integers(0, 120)),
                        st.integers(0, 200))
history_row = st.tuples(st.sampled_from(["p", "q", "r"]), key, st.sampled_from(STATUSES),
                        st.integers(-30, 200))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(pending_row, min_size=1, max_size=12), st.lists(history_row, max_size=12),
       st.integers(0, 90))
def test_await_matches_model(spark, prow, hrow, max_age):
    pending = []
    for i, (pipe, file, q_min, lin_min) in enumerate(prow):
        q = q_min if q_min in ("", None) else str(NOW_MS - q_min * MIN)
        pending.append((f"r{i}", pipe, file, q, NOW_MS - lin_min * MIN, i))
    history = []
    for j, (pipe, path, status, ago) in enumerate(hrow):
        ts_ms = NOW_MS - ago * MIN
        err = f"e{j}" if status in ("PARTIALLY_LOADED", "LOAD_FAILED") else None
        history.append((pipe, path, status, 1, 1, 1 if err else None, err, ts_ms, j))
    p_df = spark.createDataFrame([(r, p, f, {}, q, lin, s) for r, p, f, q, lin, s in pending],
                                 PENDING)
    h_df = spark.createDataFrame(
        [(p, pa, s, rp, rl, es, fe, dt.datetime.fromtimestamp(ts / 1000, dt.timezone.utc).replace(tzinfo=None), sq)
         for p, pa, s, rp, rl, es, fe, ts, sq in history], HISTORY)
    got = {}
    for r in await_results(p_df, h_df, max_age, NOW).collect():
        err = r.error
        if err and err.startswith("Flow file"):
            err = err.rsplit(" ", 1)[1]
        got[r.request_id] = (r.route, r.queued_ms, err)
    assert got == model(pending, history, max_age)


def submit_model(kind, message):
    import re
    if kind is None:
        return "success", "200", None
    if kind == "backoff":
        return "retry", None, message
    if kind == "response":
        m = re.search(r".*HTTP Status: (\d+)", message or "")
        code = m.group(1) if m else "0"
        return ("retry" if ("429" in code or "500" in code) else "failure"), code, message
    return "failure", None, message


part = st.sampled_from(["HTTP Status: ", "429", "500", "1500", "404", "x", "\n", " ", "HTTP Status: 4"])
message = st.lists(part, max_size=6).map("".join)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from([None, "backoff", "response", "other"]), message),
                min_size=1, max_size=40))
def test_submit_matches_model(spark, rows):
    from ingestflow.operators.submit import classify_submission
    df = spark.createDataFrame([(str(i), k, m) for i, (k, m) in enumerate(rows)],
                               "request_id string, kind string, message string")
    got = {r.request_id: (r.route, r.response_code, r.error_message)
           for r in classify_submission(df).collect()}
    assert got == {str(i): submit_model(k, m) for i, (k, m) in enumerate(rows)}
