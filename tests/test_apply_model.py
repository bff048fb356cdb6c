"""Apply semantics against a brute-force, event-at-a-time model."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidewater.operators import apply, changelog

SCHEMA = ("topic string, partition int, offset long, batch_id long, tableName string, "
          "actionType string, columns map<string,string>, where string")

event = st.tuples(
    st.integers(0, 2),                       # batch
    st.integers(0, 1),                       # partition
    st.sampled_from(["insert", "update", "update", "delete"]),
    st.integers(1, 3),                       # key
    st.dictionaries(st.sampled_from(["colA", "colB"]), st.integers(0, 9), min_size=1),
)


def _rows(evs):
    rows = []
    for i, (b, p, action, k, cells) in enumerate(evs):
        cols = {c: f"Integer:{v}" for c, v in cells.items()}
        if action == "insert":
            cols["custKey"] = f"Long:{k}"
        rows.append(("t", p, i, b, "customer", action, cols,
                     "" if action == "insert" else f"cust_key={k}"))
    return rows


def model(rows):
    """Events applied one at a time; zero-row updates retried once after the
    next batch (or at the end)."""
    target, status, pending = {}, {}, []

    def write(state, cells, w):
        for c, v in cells.items():
            if c not in state or w > state[c][1]:
                state[c] = (v, w)

    def cells_of(r):
        return {changelog_name(c): v.split(":", 1)[1] for c, v in r[6].items()}

    batches = sorted({r[3] for r in rows})
    for b in batches + [None]:
        evs = sorted((r for r in rows if r[3] == b), key=lambda r: (r[1], r[2]))
        new_pending = []
        for r in evs:
            eid = (r[1], r[2])
            if r[5] == "insert":
                k = r[6]["custKey"].split(":")[1]
                if k in target:
                    status[(eid, 0)] = "error"
                else:
                    target[k] = {}
                    write(target[k], cells_of(r), (False, (r[3], r[1], r[2])))
                    status[(eid, 0)] = "applied"
            elif r[5] == "update":
                k = r[7].split("=")[1]
                if k in target:
                    write(target[k], cells_of(r), (True, (r[3], r[1], r[2])))
                    status[(eid, 0)] = "applied"
                else:
                    status[(eid, 0)] = "zero_rows"
                    new_pending.append(r)
            else:
                status[(eid, 0)] = "ignored"
        for r in pending:
            k = r[7].split("=")[1]
            if k in target:
                write(target[k], cells_of(r), (True, (r[3], r[1], r[2])))
                status[((r[1], r[2]), 1)] = "applied"
            else:
                status[((r[1], r[2]), 1)] = "dead_letter"
        pending = new_pending
    final = {(k, c): v for k, cols in target.items() for c, (v, _) in cols.items()}
    return status, final


def changelog_name(name):
    return "".join("_" + ch.lower() if ch.upper() == ch and not ch.isdigit() else ch.lower()
                   for ch in name)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(event, min_size=1, max_size=12))
def test_apply_equals_event_at_a_time_model(spark, evs):
    rows = _rows(evs)
    prepared = changelog.prepare(spark.createDataFrame(rows, SCHEMA), compat=False)
    status = {((r.partition, r.offset), r.attempt): r.status
              for r in apply.status_rows(prepared).collect()}
    final = {(r.key, r.column): r.value for r in apply.final_state(prepared).collect()}
    want_status, want_final = model(rows)
    assert status == want_status
    assert final == want_final


def test_retry_runs_after_the_next_batch_present(spark):
    rows = [("t", 0, 0, 0, "customer", "update", {"v": "Integer:1"}, "cust_key=1"),
            ("t", 0, 1, 0, "customer", "update", {"v": "Integer:2"}, "cust_key=2"),
            ("t", 0, 2, 2, "customer", "insert", {"custKey": "Long:1"}, ""),   # no batch 1
            ("t", 0, 3, 5, "customer", "update", {"v": "Integer:3"}, "cust_key=3")]
    prepared = changelog.prepare(spark.createDataFrame(rows, SCHEMA), compat=False)
    got = sorted((r.offset, r.retry_after_batch, r.outcome)
                 for r in apply.retry_outcome(prepared).collect())
    assert got == [(0, 2, "applied_on_retry"), (1, 2, "dead_letter"), (3, None, "dead_letter")]
