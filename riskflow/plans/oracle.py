"""The named queries in SQL, for a second engine to check them against."""

from __future__ import annotations

from riskflow.schema import (
    INTAKE_COLUMNS,
    MESSAGE_HIGH,
    MESSAGE_LOW,
    SMOKING_STATES,
    TARGET,
    WORK_TYPE_LABEL_OTHERWISE,
    WORK_TYPE_LABELS,
    WORK_TYPES,
)

_INTAKE = """
intake AS (
  SELECT o.o_orderkey AS id,
         CASE WHEN o.o_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
         CAST(1 + (o.o_custkey * 7 + o.o_orderkey) % 100 AS INT) AS age,
         CASE WHEN o.o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS hypertension,
         CASE WHEN o.o_orderpriority = '5-LOW' THEN 1 ELSE 0 END AS heart_disease,
         CASE WHEN o.o_orderkey % 3 = 0 THEN 'No' ELSE 'Yes' END AS ever_married,
         CASE c.c_mktsegment WHEN 'HOUSEHOLD' THEN 'children' WHEN 'BUILDING' THEN 'Govt_job'
              WHEN 'FURNITURE' THEN 'Never_worked' WHEN 'MACHINERY' THEN 'Private'
              ELSE 'Self-employed' END AS work_type,
         CASE WHEN c.c_nationkey % 2 = 0 THEN 'Urban' ELSE 'Rural' END AS Residence_type,
         o.o_totalprice / CAST(2500 AS DOUBLE) AS avg_glucose_level,
         CASE WHEN c.c_acctbal < 0 THEN NULL ELSE c.c_acctbal / CAST(250 AS DOUBLE) END AS bmi,
         CASE o.o_orderstatus WHEN 'F' THEN 'formerly smoked' WHEN 'O' THEN 'smokes'
              ELSE 'never smoked' END AS smoking_status,
         CASE WHEN (1 + (o.o_custkey * 7 + o.o_orderkey) % 100) > 60
               AND (o.o_orderpriority = '1-URGENT' OR o.o_totalprice > 450000)
               AND o.o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS stroke
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""

_RAW = """
raw AS (
  SELECT * REPLACE (CASE WHEN id % 97 = 0 THEN 'abc' ELSE CAST(age AS VARCHAR) END AS age)
  FROM intake)"""

_UNASSIGNED = """
unassigned AS (
  SELECT id AS seq, CASE WHEN id % 3 = 0 THEN CAST(-1 AS BIGINT) ELSE id END AS id, gender, age
  FROM intake)"""

_SCORES = """
scores AS (
  SELECT id, stroke, age > 60 AS a_positive,
         CAST(50 + abs(age - 60) % 50 AS DOUBLE) / CAST(100 AS DOUBLE) AS a_confidence,
         avg_glucose_level > 100 AS b_positive,
         CAST(50 + (id % 40) AS DOUBLE) / CAST(100 AS DOUBLE) AS b_confidence
  FROM intake)"""


def _listed(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{value}'" for value in values)


# The form's rules on derived records, in field order.
_TAGGED = f"""
tagged AS (
  SELECT *, CASE
    WHEN gender IS NULL THEN 'gender:required'
    WHEN gender NOT IN ('Male', 'Female') THEN 'gender:domain'
    WHEN age IS NULL THEN 'age:required'
    WHEN TRY_CAST(age AS INTEGER) IS NULL THEN 'age:type'
    WHEN TRY_CAST(age AS INTEGER) NOT BETWEEN 1 AND 120 THEN 'age:range'
    WHEN hypertension NOT IN (0, 1) THEN 'hypertension:domain'
    WHEN heart_disease NOT IN (0, 1) THEN 'heart_disease:domain'
    WHEN ever_married NOT IN ('Yes', 'No') THEN 'ever_married:domain'
    WHEN work_type NOT IN ({_listed(WORK_TYPES)}) THEN 'work_type:domain'
    WHEN Residence_type NOT IN ('Rural', 'Urban') THEN 'Residence_type:domain'
    WHEN avg_glucose_level IS NULL THEN 'avg_glucose_level:required'
    WHEN avg_glucose_level NOT BETWEEN 1 AND 200 THEN 'avg_glucose_level:range'
    WHEN bmi IS NULL THEN 'bmi:required'
    WHEN bmi NOT BETWEEN 0 AND 40 THEN 'bmi:range'
    WHEN smoking_status NOT IN ({_listed(SMOKING_STATES)}) THEN 'smoking_status:domain'
  END AS reason FROM raw)"""

_RECORD = ", ".join(INTAKE_COLUMNS)


def _with(ctes: list[str], body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


def _on_intake(body: str) -> str:
    return _with([_INTAKE], body)


# ------------------------------------------------------------ feature values --
def _features() -> list[str]:
    def flag(condition: str) -> str:
        return f"CAST(CASE WHEN {condition} THEN 1 ELSE 0 END AS DOUBLE)"

    values = [
        flag("gender = 'Male'"),
        "CAST(age AS DOUBLE)",
        "CAST(hypertension AS DOUBLE)",
        "CAST(heart_disease AS DOUBLE)",
        flag("ever_married = 'Yes'"),
        *[flag(f"work_type = '{value}'") for value in WORK_TYPES],
        flag("Residence_type = 'Urban'"),
        "avg_glucose_level",
        "bmi",
        flag("smoking_status = 'formerly smoked'"),
        flag("smoking_status = 'smokes'"),
        flag("smoking_status NOT IN ('formerly smoked', 'smokes')"),
    ]
    return [f"{value} AS f{i:02d}" for i, value in enumerate(values)]


_FEATURE_LIST = ", ".join(_features())
_FEATURE_COUNT = len(_features())


# ------------------------------------------------------------ learned encoder --
def _rank_cte(name: str, source: str) -> str:
    """Index of each category: by falling count, equal counts by name."""
    return f"""
{name}_rank AS (
  SELECT CAST({name} AS VARCHAR) AS category,
         ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, CAST({name} AS VARCHAR)) - 1 AS idx
  FROM {source} GROUP BY {name})"""


def _index_categories() -> str:
    names = ["gender", "work_type", "smoking_status"]
    columns = ", ".join(f"CAST({name}_rank.idx AS DOUBLE) AS {name}_idx" for name in names)
    joins = " ".join(
        f"JOIN {name}_rank ON {name}_rank.category = intake.{name}" for name in names
    )
    return _with(
        [_INTAKE, *[_rank_cte(name, "intake") for name in names]],
        f"SELECT id, {columns} FROM intake {joins}",
    )


def _learned_encoder() -> str:
    names = [
        "gender",
        "hypertension",
        "heart_disease",
        "ever_married",
        "work_type",
        "Residence_type",
        "smoking_status",
    ]
    complete = f"\ncomplete AS (SELECT {_RECORD} FROM intake WHERE bmi IS NOT NULL)"
    # One-hot leaves out the last index, so it adds no non-zero there.
    slots = " + ".join(f"(SELECT MAX(idx) FROM {name}_rank)" for name in names)
    hits = " + ".join(
        f"(CASE WHEN {name}_rank.idx < (SELECT MAX(idx) FROM {name}_rank) THEN 1 ELSE 0 END)"
        for name in names
    )
    numerics = " + ".join(
        f"(CASE WHEN {name} <> 0 THEN 1 ELSE 0 END)" for name in ("avg_glucose_level", "bmi", "age")
    )
    joins = " ".join(
        f"JOIN {name}_rank ON {name}_rank.category = CAST(complete.{name} AS VARCHAR)"
        for name in names
    )
    return _with(
        [_INTAKE, complete, *[_rank_cte(name, "complete") for name in names]],
        f"SELECT id, CAST(3 + {slots} AS INTEGER) AS width, "
        f"CAST({numerics} + {hits} AS INTEGER) AS nonzeros FROM complete {joins}",
    )


def _learned_encoder_slots() -> str:
    numeric = ["avg_glucose_level", "bmi", "age"]
    categorical = {
        "gender": "gender",
        "hypertension": "CASE WHEN id % 13 <> 0 THEN hypertension END",
        "heart_disease": "heart_disease",
        "ever_married": "ever_married",
        "work_type": "work_type",
        "Residence_type": "Residence_type",
        "smoking_status": "CASE WHEN id % 11 <> 0 THEN smoking_status END",
    }
    gaps = ", ".join(f"CAST({value} AS VARCHAR) AS {name}" for name, value in categorical.items())
    with_gaps = f"\nwith_gaps AS (SELECT id, {', '.join(numeric)}, {gaps} FROM intake)"
    commonest = ", ".join(
        f"COALESCE({name}, (SELECT {name} FROM with_gaps WHERE {name} IS NOT NULL "
        f"GROUP BY {name} ORDER BY COUNT(*) DESC, {name} LIMIT 1)) AS {name}"
        for name in categorical
    )
    means = ", ".join(
        f"COALESCE(CAST({name} AS DOUBLE), (SELECT AVG({name}) FROM with_gaps)) AS {name}" for name in numeric
    )
    filled = f"\nfilled AS (SELECT id, {means}, {commonest} FROM with_gaps)"
    parts, before = [], str(len(numeric))
    for slot, name in enumerate(numeric):
        parts.append(f"SELECT id, {slot} AS slot, ROUND({name}, 6) AS value FROM filled WHERE ROUND({name}, 6) <> 0")
    for name in categorical:
        last = f"(SELECT MAX(idx) FROM {name}_rank)"
        parts.append(
            f"SELECT id, CAST({before} + idx AS INTEGER), CAST(1 AS DOUBLE) FROM filled "
            f"JOIN {name}_rank ON category = {name} WHERE idx < {last}"
        )
        before += f" + {last}"
    ranks = [_rank_cte(name, "filled") for name in categorical]
    return _with([_INTAKE, with_gaps, filled, *ranks], "\nUNION ALL\n".join(parts))


_LEARNED_ENCODER_WIDE = """
WITH items AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_orderkey % 5 <> 0 THEN CAST(l_orderkey AS VARCHAR) END AS ord,
         CASE WHEN l_partkey % 7 <> 0 THEN l_returnflag END AS mode,
         CASE WHEN l_linenumber <> 4 THEN CAST(l_quantity AS DOUBLE) END AS quantity
  FROM lineitem),
ord_rank AS (
  SELECT ord, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, ord) - 1 AS idx
  FROM items WHERE ord IS NOT NULL GROUP BY ord),
mode_rank AS (
  SELECT mode, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, mode) - 1 AS idx
  FROM items WHERE mode IS NOT NULL GROUP BY mode),
counts AS (
  SELECT (SELECT COUNT(*) FROM ord_rank) AS n_ord, (SELECT COUNT(*) FROM mode_rank) AS n_mode,
         (SELECT AVG(quantity) FROM items) AS mean),
placed AS (
  SELECT l_orderkey, l_linenumber, n_ord, n_mode, COALESCE(quantity, mean) AS quantity,
         COALESCE(o.idx, 0) AS o, COALESCE(m.idx, 0) AS m
  FROM items CROSS JOIN counts LEFT JOIN ord_rank o ON items.ord = o.ord
       LEFT JOIN mode_rank m ON items.mode = m.mode)
SELECT l_orderkey, l_linenumber, CAST(n_ord + n_mode - 1 AS INTEGER) AS width,
       concat_ws(',', CASE WHEN quantity <> 0 THEN '0' END,
                 CASE WHEN o < n_ord - 1 THEN CAST(1 + o AS VARCHAR) END,
                 CASE WHEN m < n_mode - 1 THEN CAST(n_ord + m AS VARCHAR) END) AS slots,
       ROUND(quantity + CASE WHEN o < n_ord - 1 THEN 1 ELSE 0 END
             + CASE WHEN m < n_mode - 1 THEN 1 ELSE 0 END, 6) AS total
FROM placed"""


# -------------------------------------------------------------------- texts --
_WORK_LABEL = (
    "CASE work_type "
    + " ".join(f"WHEN '{code}' THEN '{label}'" for code, label in WORK_TYPE_LABELS.items())
    + f" ELSE '{WORK_TYPE_LABEL_OTHERWISE}' END"
)
_STABLE_KEY = "md5(concat_ws('|', CAST(id AS VARCHAR), '42'))"
_TRAIN_SIDE = f"{_STABLE_KEY} < 'b3333333'"
_LAST_EVENT = """
SELECT event_id, user_id, event_type, value, props FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1"""
_VERDICT = """
SELECT id, CASE WHEN a_confidence > b_confidence THEN a_positive ELSE b_positive END AS positive
FROM scores"""
_CONFUSION = """
cells AS (
  SELECT COUNT(*) FILTER (WHERE stroke = 1 AND age > 70) AS tp,
         COUNT(*) FILTER (WHERE stroke = 0 AND age > 70) AS fp,
         COUNT(*) FILTER (WHERE stroke = 1 AND age <= 70) AS fn,
         COUNT(*) FILTER (WHERE stroke = 0 AND age <= 70) AS tn
  FROM intake)"""

ORACLE_SQL: dict[str, str] = {
    "scan_intake": _on_intake(f"SELECT {_RECORD} FROM intake"),
    "csv_round_trip": _on_intake(
        """
SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE bmi IS NULL) AS n_null_bmi,
       COUNT(*) FILTER (WHERE gender IS NULL) AS n_null_gender,
       CAST(SUM(id) AS BIGINT) AS sum_id, CAST(SUM(age) AS BIGINT) AS sum_age,
       CAST(SUM(stroke) AS BIGINT) AS sum_stroke,
       MIN(avg_glucose_level) AS min_glucose, MAX(bmi) AS max_bmi
FROM intake"""
    ),
    "csv_rejected": _on_intake(
        "SELECT CASE WHEN id % 89 = 0 THEN 'age:type' WHEN id % 83 = 0 THEN 'bmi:type' ELSE 'ok' END AS reason, "
        "COUNT(*) AS n FROM intake GROUP BY 1"
    ),
    "export_round_trip": _on_intake(f"SELECT {_RECORD} FROM intake"),
    "audit_metrics": _on_intake(
        "SELECT COUNT(*) AS n, MIN(id) AS min_id, MAX(id) AS max_id, "
        "COUNT(*) FILTER (WHERE stroke = 1) AS n_positive FROM intake"
    ),
    "drop_incomplete": _on_intake(f"SELECT {_RECORD}, {TARGET} FROM intake WHERE bmi IS NOT NULL"),
    "labelled_set": _on_intake("SELECT id, CAST(stroke AS DOUBLE) AS label FROM intake"),
    "class_filter": _on_intake(f"SELECT {_RECORD}, {TARGET} FROM intake WHERE stroke = 1"),
    "lookup_by_id": _on_intake(
        f"SELECT {_RECORD} FROM intake WHERE id IN (0, 42, 1234, 9999999999)"
    ),
    "lookup_many": _on_intake(
        f"SELECT {_RECORD} FROM intake WHERE id IN (SELECT user_id FROM events)"
    ),
    "validate_reasons": _with(
        [_INTAKE, _RAW, _TAGGED],
        "SELECT COALESCE(reason, 'ok') AS reason, COUNT(*) AS n FROM tagged GROUP BY 1",
    ),
    "validated_ok": _with(
        [_INTAKE, _RAW, _TAGGED],
        f"SELECT {_RECORD.replace('age,', 'CAST(age AS INTEGER) AS age,', 1)} "
        "FROM tagged WHERE reason IS NULL",
    ),
    "rejected_rows": _with(
        [_INTAKE, _RAW, _TAGGED],
        "SELECT id, age, bmi, reason FROM tagged WHERE reason IS NOT NULL",
    ),
    "decode_for_review": _on_intake(
        f"""
SELECT id, CASE WHEN hypertension = 1 THEN 'Yes' ELSE 'No' END AS hypertension,
       CASE WHEN heart_disease = 1 THEN 'Yes' ELSE 'No' END AS heart_disease,
       {_WORK_LABEL} AS work_type FROM intake"""
    ),
    "risk_message": _on_intake(
        f"SELECT id, CASE WHEN age > 60 THEN '{MESSAGE_HIGH}' ELSE '{MESSAGE_LOW}' END AS message "
        "FROM intake"
    ),
    "assign_ids": _with(
        [_INTAKE, _UNASSIGNED],
        """
SELECT seq, id, id AS new_id FROM unassigned WHERE id >= 0
UNION ALL
SELECT seq, id, (SELECT MAX(id) + 1 FROM unassigned WHERE id >= 0)
                + ROW_NUMBER() OVER (ORDER BY seq) - 1 AS new_id
FROM unassigned WHERE id < 0""",
    ),
    "next_id": _with(
        [_INTAKE, _UNASSIGNED],
        "SELECT CAST(COALESCE(MAX(id) + 1, 0) AS BIGINT) AS next_id FROM unassigned",
    ),
    "top_record": _on_intake(
        f"SELECT {_RECORD}, {TARGET} FROM intake ORDER BY id DESC LIMIT 1"
    ),
    "review_summary": _on_intake(
        f"SELECT COUNT(*) AS n, ARG_MIN(id, {_STABLE_KEY}) AS sampled_id FROM intake"
    ),
    "review_page": _on_intake(
        f"""
SELECT * EXCLUDE (stroke) REPLACE (
         CASE WHEN hypertension = 1 THEN 'Yes' ELSE 'No' END AS hypertension,
         CASE WHEN heart_disease = 1 THEN 'Yes' ELSE 'No' END AS heart_disease,
         {_WORK_LABEL} AS work_type),
       (SELECT COUNT(*) FROM intake) AS n_waiting
FROM intake WHERE id = (SELECT ARG_MIN(id, {_STABLE_KEY}) FROM intake)"""
    ),
    "class_balance": _on_intake(
        "SELECT COUNT(*) AS n_all, COUNT(*) FILTER (WHERE stroke = 1) AS n_positive FROM intake"
    ),
    "class_balance_labels": (
        "SELECT COUNT(*) AS n_all, COUNT(*) FILTER (WHERE toxic = 1) AS n_positive FROM labels"
    ),
    "class_weights": _on_intake(
        """
SELECT id, CASE WHEN stroke = 1
  THEN (SELECT CAST(COUNT(*) AS DOUBLE) / CAST(SUM(stroke) AS DOUBLE) FROM intake)
  ELSE CAST(1 AS DOUBLE) END AS weights FROM intake"""
    ),
    "class_weights_labels": """
SELECT doc_id, CASE WHEN toxic = 1
  THEN (SELECT CAST(COUNT(*) AS DOUBLE) / CAST(SUM(toxic) AS DOUBLE) FROM labels)
  ELSE CAST(1 AS DOUBLE) END AS weights FROM labels""",
    "split_counts": _on_intake(
        f"""
SELECT CASE WHEN {_TRAIN_SIDE} THEN 'train' ELSE 'test' END AS side, COUNT(*) AS n,
       CAST(SUM(stroke) AS BIGINT) AS n_positive
FROM intake GROUP BY 1"""
    ),
    "train_split": _on_intake(f"SELECT id FROM intake WHERE {_TRAIN_SIDE}"),
    "upsert_latest": _LAST_EVENT,
    "upsert_records": _on_intake(
        """
SELECT id, CASE WHEN stroke = 1 OR bmi IS NULL THEN age + 1 ELSE age END AS age, bmi, stroke
FROM intake"""
    ),
    "encode_features": _on_intake(f"SELECT id, {_FEATURE_LIST} FROM intake WHERE bmi IS NOT NULL"),
    "encode_stats": _with(
        [_INTAKE, f"\nencoded AS (SELECT {_FEATURE_LIST} FROM intake WHERE bmi IS NOT NULL)"],
        "SELECT "
        + ", ".join(
            f"MIN(f{i:02d}) AS f{i:02d}_min, MAX(f{i:02d}) AS f{i:02d}_max"
            for i in range(_FEATURE_COUNT)
        )
        + " FROM encoded",
    ),
    "encode_width": _on_intake(
        f"SELECT COUNT(*) AS n, {_FEATURE_COUNT} AS min_width, {_FEATURE_COUNT} AS max_width "
        "FROM intake WHERE bmi IS NOT NULL"
    ),
    "impute_mean": _on_intake(
        "SELECT id, ROUND(COALESCE(bmi, AVG(bmi) OVER ()), 6) AS bmi FROM intake"
    ),
    "impute_mode": _on_intake(
        """
SELECT id, CASE WHEN bmi IS NOT NULL THEN hypertension ELSE (
    SELECT hypertension FROM intake WHERE bmi IS NOT NULL
    GROUP BY hypertension ORDER BY COUNT(*) DESC, hypertension LIMIT 1) END AS hypertension
FROM intake"""
    ),
    "index_categories": _index_categories(),
    "index_categories_wide": _with(
        [_rank_cte("l_orderkey", "lineitem").lstrip()],
        "SELECT l_orderkey, l_linenumber, CAST(idx AS DOUBLE) AS l_orderkey_idx FROM lineitem "
        "JOIN l_orderkey_rank ON category = CAST(l_orderkey AS VARCHAR)",
    ),
    "learned_encoder": _learned_encoder(),
    "learned_encoder_slots": _learned_encoder_slots(),
    "learned_encoder_wide": _LEARNED_ENCODER_WIDE,
    "confusion": _with([_INTAKE, _CONFUSION], "SELECT tp, fp, fn, tn FROM cells"),
    "hard_auc": _with(
        [
            _INTAKE,
            _CONFUSION,
            """
rates AS (
  SELECT CAST(tp AS DOUBLE) / (tp + fn) AS r, CAST(tn AS DOUBLE) / (tn + fp) AS s,
         CAST(tp AS DOUBLE) / (tp + fp) AS p,
         CAST(tp + fn AS DOUBLE) / (tp + fp + fn + tn) AS prevalence
  FROM cells)""",
        ],
        "SELECT ROUND((r + s) / 2, 6) AS auroc, "
        "ROUND(r * p + (1 - r) * (p + prevalence) / 2, 6) AS auprc FROM rates",
    ),
    "arbitrate": _with([_INTAKE, _SCORES], _VERDICT),
    "arbitrate_joined": _with([_INTAKE, _SCORES], _VERDICT),
    "export_json": _on_intake(
        f"SELECT {_RECORD}, CASE WHEN bmi IS NULL THEN '{','.join(n for n in INTAKE_COLUMNS if n != 'bmi')}' "
        f"ELSE '{','.join(INTAKE_COLUMNS)}' END AS fields FROM intake"
    ),
    "json_path": _on_intake("SELECT id, work_type FROM intake"),
    "events_json_path": (
        "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"
    ),
    "export_name": (
        "SELECT event_id, CAST(event_id AS VARCHAR) || '_' || strftime(ts, '%Y-%m-%d_%H:%M:%S.%f') "
        "|| '.bin.gz' AS name FROM events"
    ),
    "stream_upsert": _LAST_EVENT,
    "stream_export": "SELECT event_id, user_id, event_type, value, props FROM events",
    "stream_fanout": _with(
        [_INTAKE, "\nraw AS (SELECT * FROM intake)", _TAGGED],
        "SELECT COUNT(*) AS n_stored, CAST(SUM(id) AS BIGINT) AS sum_id_stored, "
        "COUNT(*) AS n_encoded, CAST(SUM(id) AS BIGINT) AS sum_id_encoded "
        "FROM tagged WHERE reason IS NULL",
    ),
}

_PARTS = """
parts AS (
  SELECT *, FLOOR((id - (SELECT MIN(id) FROM intake))
                  / ((SELECT MAX(id) - MIN(id) FROM intake) // 4 + 1)) AS part FROM intake)"""

# The target of the models is this field.
_LEARNED = "SELECT id, heart_disease = 1 AS positive"
_LEARNED_MESSAGE = f"CASE WHEN heart_disease = 1 THEN '{MESSAGE_HIGH}' ELSE '{MESSAGE_LOW}' END AS message"

ORACLE_SQL |= {
    "store_upsert_bucketed": ORACLE_SQL["upsert_records"],
    "lookup_bucketed": ORACLE_SQL["lookup_by_id"],
    "stream_assign_ids": ORACLE_SQL["assign_ids"],
    "stream_intake_text": _with(
        [_INTAKE, _RAW, _TAGGED],
        "SELECT CASE WHEN id % 101 = 0 THEN 'line:malformed' ELSE COALESCE(reason, 'ok') END AS reason, "
        "COUNT(*) AS n FROM tagged GROUP BY 1",
    ),
    "stream_compact_twice": _LAST_EVENT,
    "stream_state_latest": _LAST_EVENT,
    "stream_batches": _with(
        [_INTAKE, _PARTS],
        "SELECT ROW_NUMBER() OVER (ORDER BY part) - 1 AS batch, COUNT(*) AS n FROM parts GROUP BY part",
    ),
    "stream_audit": ORACLE_SQL["audit_metrics"],
    "stream_arbitrate_joined": _with([_INTAKE, _SCORES], _VERDICT),
    "score_learned_forest": _on_intake(_LEARNED + ", TRUE AS sure FROM intake WHERE bmi IS NOT NULL"),
    "score_learned_gbt": _on_intake(_LEARNED + ", TRUE AS sure FROM intake WHERE bmi IS NOT NULL"),
    "score_learned_svc": _on_intake(_LEARNED + " FROM intake WHERE bmi IS NOT NULL"),
    "model_reload": _on_intake(_LEARNED + " FROM intake WHERE bmi IS NOT NULL"),
    "stream_score_learned": _with(
        [_INTAKE, _RAW, _TAGGED],
        f"{_LEARNED}, {_LEARNED_MESSAGE} FROM tagged WHERE reason IS NULL AND id % 101 <> 0",
    ),
    "intake_verdicts": _with(
        [_INTAKE, _RAW, _TAGGED], f"{_LEARNED}, {_LEARNED_MESSAGE} FROM tagged WHERE reason IS NULL"
    ),
    "intake_stored": _with(
        [_INTAKE, _RAW, _TAGGED],
        f"SELECT {_RECORD} FROM (SELECT intake.* REPLACE (CASE WHEN tagged.reason IS NULL THEN intake.age "
        "ELSE intake.age - 1 END AS age) FROM intake JOIN tagged USING (id)) WHERE bmi IS NOT NULL",
    ),
    "intake_rejected": _with(
        [_INTAKE, _RAW, _TAGGED], "SELECT id, age, reason FROM tagged WHERE reason IS NOT NULL"
    ),
}
