"""Property test: the contract's JSON type rules against JSON Schema semantics.

JSON Schema: ``integer`` = any number with zero fractional part (5 and 5.0, not
5.5, not true); ``number`` = any number (not booleans, not strings); ``string``
and ``boolean`` are exact; ``null`` only where the type union allows it.
"""

import json
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from fleetlake.plans import ingest
from fleetlake.schemas import FieldSpec, StreamSpec

SPEC = StreamSpec(name="probe", topic="t", key="i", fields=(
    FieldSpec("i", "integer", T.LongType()),
    FieldSpec("n", "number", T.DoubleType()),
    FieldSpec("s", "string", T.StringType()),
    FieldSpec("b", "boolean", T.BooleanType()),
    FieldSpec("o", "string", T.StringType(), nullable_json=True),
))

values = st.one_of(
    st.none(), st.booleans(), st.integers(-10**12, 10**12), st.text(max_size=5),
    st.floats(min_value=-1e15, max_value=1e15, allow_nan=False),
    st.integers(-10**6, 10**6).map(float),
    st.integers(-10**4, 10**4).map(lambda x: x * 1e16),  # whole numbers printed with an exponent
    st.sampled_from([1.5e16, 2.5e-7, 5.0, 5.5, -0.0]),
    st.lists(st.integers(0, 3), max_size=2),
)


def expected_ok(kind: str, v) -> bool:
    if kind == "integer":
        return isinstance(v, int) and not isinstance(v, bool) or (isinstance(v, float) and v == math.floor(v))
    if kind == "number":
        return isinstance(v, (int, float)) and not isinstance(v, bool)
    if kind == "string":
        return isinstance(v, str)
    if kind == "boolean":
        return isinstance(v, bool)
    if kind == "string|null":
        return v is None or isinstance(v, str)
    raise AssertionError(kind)


KINDS = {"i": "integer", "n": "number", "s": "string", "b": "boolean", "o": "string|null"}


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.fixed_dictionaries({k: values for k in KINDS}), min_size=60, max_size=60))
def test_type_rules_match_json_schema(spark, records):
    texts = [json.dumps(r) for r in records]
    got = ingest.validate(spark.createDataFrame([(t,) for t in texts], "value string"), SPEC).collect()
    for rec, row in zip(records, got):
        for k, kind in KINDS.items():
            flagged = f"type:{k}" in row["_violations"]
            assert flagged == (not expected_ok(kind, rec[k])), (k, rec[k], row["_violations"])


def test_whole_numbers_beyond_the_stored_type_and_null_items_are_rejected(spark):
    import json

    from fleetlake.schemas import STREAMS
    from fleetlake.plans import ingest
    rows = []
    base = {
        "telemetry": {"event_id": "e", "device_id": "d", "qubit_id": 1, "T1_us": 100.0, "T2_us": 100.0, "gate_error_1q": 0.001,
                      "gate_error_2q": 0.01, "readout_fidelity": 0.95, "timestamp": "2024-01-01T00:00:00Z"},
    }
    spec = STREAMS["telemetry"]
    names = {f.name for f in spec.fields}
    msg = {k: v for k, v in base["telemetry"].items() if k in names}
    for bad in (3000000000, 10**16, 99999999999999999999, 1):
        rows.append((json.dumps(msg | {"qubit_id": bad}),))
    got = [r._violations for r in ingest.validate(spark.createDataFrame(rows, "value string"), spec).collect()]
    assert all("range:qubit_id" in v for v in got[:3]) and "range:qubit_id" not in got[3]
    items = [(json.dumps({"active_alerts": x}),) for x in (["a", None], ["a"], [])]
    got = [r._violations for r in ingest.validate(spark.createDataFrame(items, "value string"), STREAMS["health"]).collect()]
    assert ["items:active_alerts" in v for v in got] == [True, False, False]
