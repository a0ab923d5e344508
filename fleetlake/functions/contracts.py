"""Event contracts as Column expressions.

A contract (``StreamSpec``) compiles to one ``array<string>`` column of violation
names, evaluated per record on the JVM: the JSON text is parsed once to a
VARIANT, keys come from that value, and all fields' JSON types and all their values
from one ``try_variant_get`` each. The rules are tested first as one condition, and
the list of names is only built for a record that breaks one. No Python runs per
record.

Violation names: ``unparsable_json``, ``not_object``, ``required:<f>``,
``additional:<f>``, ``type:<f>``, ``minimum:<f>``, ``maximum:<f>``,
``minLength:<f>``, ``enum:<f>``, ``pattern:<f>``, ``items:<f>``,
``timestamp:<f>`` (text that is not an ISO-8601 date-time) and the domain rule
names of ``DOMAIN_RULES``. Domain rules run only on records that pass the
structural contract, as the reference validates schema first.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.functions.exprs import non_null
from fleetlake.functions.timestamps import parse_iso_timestamp
from fleetlake.schemas import FieldSpec, StreamSpec

INTEGER_TYPES = ("TINYINT", "SMALLINT", "INT", "BIGINT")


def type_ok(t: Column, f: FieldSpec, whole: Column | None = None) -> Column:
    """JSON Schema type check on the inferred Variant type name.

    ``integer`` accepts integral numbers, including decimals with zero scale
    (``5.0``) and whole doubles (``1e+16``, via ``whole``), and rejects ``5.5``
    and ``true``; ``number`` accepts any numeric.
    """
    if f.json_type == "integer":
        ok = t.isin(*INTEGER_TYPES) | t.rlike(r"^DECIMAL\(\d+,0\)$")
        if whole is not None:
            ok = ok | (t.isin("DOUBLE", "FLOAT") & F.coalesce(whole, F.lit(False)))
    elif f.json_type == "number":
        ok = t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT", *INTEGER_TYPES)
    elif f.json_type in ("string", "date-time"):
        ok = t == "STRING"
    elif f.json_type == "boolean":
        ok = t == "BOOLEAN"
    elif f.json_type == "array":
        ok = t.startswith("ARRAY<")
    else:
        raise ValueError(f"unsupported JSON type {f.json_type}")
    if f.nullable_json:
        ok = ok | (t == "VOID")
    return ok


Rule = tuple[Column, str]
"""A condition and the violation's name; a null condition does not fire."""


def any_fires(rules: list[Rule]) -> Column:
    """Whether one of the rules fires; it stops at the first that does, and each condition has its cheap part first.

    A chain of ``or`` would be generated as one method, too large for the JIT; ``coalesce`` is split into several.
    """
    return F.coalesce(*[F.when(cond, F.lit(True)) for cond, _ in rules], F.lit(False))


def names_of(rules: list[Rule]) -> Column:
    """The names of the rules that fire, in order."""
    return non_null(*[F.when(cond, F.lit(name)) for cond, name in rules])


def type_col(name: str) -> str:
    return f"_t_{name}"


def whole_col(name: str) -> str:
    return f"_w_{name}"


def _struct(spec: StreamSpec, types: Callable[[FieldSpec], str]) -> str:
    return "struct<" + ",".join(f"`{f.name.replace('`', '``')}`:{types(f)}" for f in spec.fields) + ">"


def _member(struct: str, name: str) -> Column:
    return F.col(struct).getField(name)


def parse(messages: DataFrame, text: Column, spec: StreamSpec, carry: Sequence[str | Column] = ()) -> DataFrame:
    """``carry``, the typed fields, and what the rules read: ``_keys`` (top-level keys, null unless the text is an
    object), ``_parsed`` and per field its inferred JSON type (``_t_<f>``).

    The text is parsed once, and its value is walked three times: for the keys, the types and the values. Each step is a
    projection of its own, so that nothing is computed again for every rule that reads it.
    """
    v = messages.select(*carry, F.try_parse_json(text).alias("_v"))
    names = v.columns[:-1]
    value = _struct(spec, lambda f: "string" if f.json_type == "date-time" else f.spark_type.simpleString())
    whole = [f for f in spec.fields if f.json_type == "integer"]
    p = v.select(*names, F.col("_v").isNotNull().alias("_parsed"),
                 F.map_keys(F.try_variant_get("_v", "$", "map<string,variant>")).alias("_keys"),
                 F.try_variant_get("_v", "$", _struct(spec, lambda f: "variant")).alias("_f"),
                 F.try_variant_get("_v", "$", value).alias("_x"))
    types = [F.schema_of_variant(_member("_f", f.name)).alias(type_col(f.name)) for f in spec.fields]
    p = p.select(*names, "_parsed", "_keys", "_x", *types, *[_member("_f", f.name).alias(whole_col(f.name)) for f in whole])
    values = [parse_iso_timestamp(_member("_x", f.name)) if f.json_type == "date-time" else _member("_x", f.name)
              for f in spec.fields]
    return p.select(*names, "_parsed", "_keys", *[type_col(f.name) for f in spec.fields],
                    *[_whole(f).alias(whole_col(f.name)) for f in whole],
                    *[c.alias(f.name) for c, f in zip(values, spec.fields)])


def _whole(f: FieldSpec) -> Column:
    """Whether a double is whole; null for any other JSON type (floor() is BIGINT-bound, so ``%``)."""
    d = F.try_variant_get(whole_col(f.name), "$", "double")
    return F.when(F.col(type_col(f.name)).isin("DOUBLE", "FLOAT"), d % F.lit(1.0) == F.lit(0.0))


def field_rules(f: FieldSpec) -> list[Rule]:
    """Rules of one field over the projected ``_t_<f>`` and ``<f>`` columns."""
    t, x = F.col(type_col(f.name)), F.col(f.name)
    ok = type_ok(t, f, F.col(whole_col(f.name)) if f.json_type == "integer" else None)
    present_ok = t.isNotNull() & ok & (t != "VOID")
    out = [(t.isNotNull() & ~ok, f"type:{f.name}")]
    if f.json_type == "integer":
        # a whole number that the stored type cannot hold
        out.append((x.isNull() & present_ok, f"range:{f.name}"))
    if f.minimum is not None:
        out.append(((x < F.lit(f.minimum)) & present_ok, f"minimum:{f.name}"))
    if f.maximum is not None:
        out.append(((x > F.lit(f.maximum)) & present_ok, f"maximum:{f.name}"))
    if f.min_length is not None:
        out.append(((F.char_length(x) < f.min_length) & present_ok, f"minLength:{f.name}"))
    if f.enum is not None:
        out.append((~x.isin(*f.enum) & present_ok, f"enum:{f.name}"))
    if f.pattern is not None:
        out.append((~x.rlike(f.pattern) & present_ok, f"pattern:{f.name}"))
    if f.json_type == "array" and f.item_type == "string":
        # every item a string (a null item leaves the type ARRAY<STRING>), or an empty array (typed ARRAY<VOID>)
        items_ok = ((t == "ARRAY<STRING>") & (F.size(F.array_compact(x)) == F.size(x))) | ((t == "ARRAY<VOID>") & (F.size(x) == 0))
        out.append((~items_ok & present_ok, f"items:{f.name}"))
    if f.json_type == "date-time":
        out.append((x.isNull() & present_ok, f"timestamp:{f.name}"))
    return out


def violations(spec: StreamSpec, domain: bool = True) -> Column:
    """All violations, over a frame from ``parse``; ``array<string>``, empty for most records.

    One ``required:<f>`` per missing key; all unexpected keys in one
    ``additional:<k1>,<k2>`` (as JSON Schema reports that rule). Domain rules are read
    when no structural rule fires.
    """
    keys = F.col("_keys")
    missing = [(F.col(type_col(f.name)).isNull(), f"required:{f.name}") for f in spec.fields]
    rules = [r for f in spec.fields for r in field_rules(f)]
    # a lambda on purpose: it keeps this projection, too large for one method, out of whole-stage codegen, while
    # the parse below it stays in; otherwise Spark gives up whole-stage codegen for both
    extra = F.filter(keys, lambda k: ~k.isin(*spec.names))
    additional = F.when(F.size(extra) > 0, F.concat(F.lit("additional:"), F.array_join(extra, ",")))
    named = F.when(~F.col("_parsed"), F.array(F.lit("unparsable_json"))).when(keys.isNull(), F.array(F.lit("not_object"))) \
        .otherwise(non_null(*[F.when(c, F.lit(n)) for c, n in missing], additional, *[F.when(c, F.lit(n)) for c, n in rules]))
    # keys are distinct: without a missing one, another number of keys means unexpected ones
    other = (keys.isNull() | (F.size(keys) != len(spec.fields)), "")
    out = F.when(any_fires([other, *missing, *rules]), named)
    own = DOMAIN_RULES.get(spec.name)
    if domain and own is not None:
        out = out.when(any_fires(own(F.col)), names_of(own(F.col)))
    return out.otherwise(F.array().cast("array<string>"))


# ---------------------------------------------------------------------------
# Domain rules per stream (on typed columns). Thresholds of the
# ingest-time checks (the T2 tolerance is ingest-only; silver is exact).
# ---------------------------------------------------------------------------
T2_TOLERANCE = 1e-6
TOTAL_TIME_TOLERANCE = 0.05
DURATION_RANGE = (60.0, 3600.0)
SCORE_RANGE = (0.0, 1.0)
CRYO_RANGE = (5.0, 100.0)


def _telemetry_rules(c: Callable[[str], Column]) -> list[Rule]:
    return [(c("T2_us") > 2 * c("T1_us") + F.lit(T2_TOLERANCE), "t2_exceeds_2x_t1"),
            (c("gate_error_2q") < c("gate_error_1q"), "gate_error_2q_below_1q")]


def _calibration_rules(c):
    lo, hi = DURATION_RANGE
    return [(c("qubits_calibrated") > c("qubits_total"), "qubits_calibrated_exceeds_total"),
            (~c("duration_seconds").between(lo, hi), "duration_implausible")]


def _jobs_rules(c):
    return [(F.abs(c("total_time_seconds") - (c("queue_wait_seconds") + c("exec_time_seconds")))
                  > F.lit(TOTAL_TIME_TOLERANCE), "total_time_mismatch"),
            (c("status").isin("completed", "cancelled") & c("error_code").isNotNull(),
                  "error_code_on_success")]


def _health_rules(c):
    return [(~c("system_health_score").between(*SCORE_RANGE), "health_score_out_of_range"),
            (~c("cryo_temp_mk").between(*CRYO_RANGE), "cryo_temp_implausible"),
            (c("active_alerts").isNull(), "active_alerts_not_list")]


DOMAIN_RULES = {"telemetry": _telemetry_rules, "calibration": _calibration_rules,
                "jobs": _jobs_rules, "health": _health_rules}


def domain_violations(spec: StreamSpec, c: Callable[[str], Column] = F.col) -> Column:
    """Domain-rule violations of typed rows, as ``array<string>`` (empty if the
    stream has no domain rules)."""
    rules = DOMAIN_RULES.get(spec.name)
    if rules is None:
        return F.array().cast("array<string>")
    return names_of(rules(c))
