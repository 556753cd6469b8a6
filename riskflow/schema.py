"""Record schemas, form rules and the feature layout, all stated as data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Field names, category vocabularies, form bounds, display texts
# and training parameters.  Results are only right if these stay as they are.
# --------------------------------------------------------------------------
GENDERS = ("Male", "Female")
YES_NO = ("Yes", "No")
WORK_TYPES = ("children", "Govt_job", "Never_worked", "Private", "Self-employed")
RESIDENCE_TYPES = ("Rural", "Urban")
SMOKING_STATES = ("formerly smoked", "never smoked", "smokes")

WORK_TYPE_LABELS = {
    "children": "Children care",
    "Govt_job": "Government job",
    "Never_worked": "Never worked",
    "Private": "Private company",
}
WORK_TYPE_LABEL_OTHERWISE = "Self-employed"

MESSAGE_HIGH = "You have a high chance of having a stroke. Please consult with a doctor."
MESSAGE_LOW = "Your chances of having a stroke are low."

UNASSIGNED_ID = -1
CSV_NULL = "N/A"
TRAIN_FRACTION = 0.7

FOREST_TREES = 200
FOREST_DEPTH = 10
GBT_ITERATIONS = 20
GBT_DEPTH = 10
SVC_ITERATIONS = 100
SVC_REG_PARAM = 0.1
# --------------------------------------------------------------------------

ID = "id"
TARGET = "stroke"

INTAKE = T.StructType(
    [
        T.StructField("gender", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("hypertension", T.IntegerType()),
        T.StructField("heart_disease", T.IntegerType()),
        T.StructField("ever_married", T.StringType()),
        T.StructField("work_type", T.StringType()),
        T.StructField("Residence_type", T.StringType()),
        T.StructField("avg_glucose_level", T.DoubleType()),
        T.StructField("bmi", T.DoubleType()),
        T.StructField("smoking_status", T.StringType()),
        T.StructField(ID, T.LongType()),
    ]
)
INTAKE_COLUMNS = tuple(INTAKE.fieldNames())
ATTRIBUTES = tuple(name for name in INTAKE_COLUMNS if name != ID)


def _training_type(field: T.StructField) -> T.DataType:
    return field.dataType if isinstance(field.dataType, T.StringType) else T.DoubleType()


#: CSV training file: ``id`` first, numerics as double, target last.
TRAINING = T.StructType(
    [T.StructField(ID, T.LongType())]
    + [T.StructField(f.name, _training_type(f)) for f in INTAKE if f.name != ID]
    + [T.StructField(TARGET, T.DoubleType())]
)


# ------------------------------------------------------------- form rules --
@dataclass(frozen=True)
class Rule:
    """One constraint on one field; a record fails with reason ``field:kind``."""

    field: str
    kind: str  # required | type | range | domain | step
    low: float | None = None
    high: float | None = None
    values: tuple = ()
    step: float | None = None

    @property
    def reason(self) -> str:
        return f"{self.field}:{self.kind}"


def _choice(field: str, values: tuple) -> list[Rule]:
    return [Rule(field, "required"), Rule(field, "type"), Rule(field, "domain", values=values)]


def _number(field: str, low: float, high: float, step: float) -> list[Rule]:
    return [
        Rule(field, "required"),
        Rule(field, "type"),
        Rule(field, "range", low=low, high=high),
        Rule(field, "step", low=low, step=step),
    ]


#: Constraints of the intake form, in field order; the first one broken names the reason.
FORM_RULES: tuple[Rule, ...] = tuple(
    _choice("gender", GENDERS)
    + _number("age", 1, 120, 1)
    + _choice("hypertension", (0, 1))
    + _choice("heart_disease", (0, 1))
    + _choice("ever_married", YES_NO)
    + _choice("work_type", WORK_TYPES)
    + _choice("Residence_type", RESIDENCE_TYPES)
    + _number("avg_glucose_level", 1, 200, 0.1)
    + _number("bmi", 0, 40, 0.1)
    + _choice("smoking_status", SMOKING_STATES)
    + [Rule(ID, "type")]
)


def without_steps(rules: tuple[Rule, ...] = FORM_RULES) -> tuple[Rule, ...]:
    """The same rules for sources whose numbers are not on the form's 0.1 grid."""
    return tuple(rule for rule in rules if rule.kind != "step")


# --------------------------------------------------------- feature layout --
#: Unknown policies: fail the job, or (one-hot only) fill the last, catch-all slot.
ERROR = "error"
CATCH_ALL = "catch_all"


@dataclass(frozen=True)
class Numeric:
    field: str
    width: int = 1


@dataclass(frozen=True)
class Binary:
    """Two categories as 0/1.  ``unknown`` is ``ERROR`` or the value for all others."""

    field: str
    mapping: tuple[tuple[str, float], ...]
    unknown: str | float = ERROR
    width: int = 1


@dataclass(frozen=True)
class OneHot:
    """One slot per vocabulary entry, plus one more under ``CATCH_ALL``."""

    field: str
    vocabulary: tuple[str, ...]
    unknown: str = ERROR

    @property
    def width(self) -> int:
        return len(self.vocabulary) + (1 if self.unknown == CATCH_ALL else 0)


@dataclass(frozen=True)
class EncodingSpec:
    parts: tuple[Numeric | Binary | OneHot, ...]

    @property
    def width(self) -> int:
        return sum(part.width for part in self.parts)


def _layout(gender_unknown: str | float) -> EncodingSpec:
    return EncodingSpec(
        (
            Binary("gender", (("Female", 0.0), ("Male", 1.0)), unknown=gender_unknown),
            Numeric("age"),
            Numeric("hypertension"),
            Numeric("heart_disease"),
            Binary("ever_married", (("Yes", 1.0), ("No", 0.0))),
            OneHot("work_type", WORK_TYPES),
            Binary("Residence_type", (("Urban", 1.0),), unknown=0.0),
            Numeric("avg_glucose_level"),
            Numeric("bmi"),
            OneHot("smoking_status", ("formerly smoked", "smokes"), unknown=CATCH_ALL),
        )
    )


#: Scoring refuses a third gender; training counts it as 1.0.
SERVING_SPEC = _layout(ERROR)
TRAINING_SPEC = _layout(1.0)
