"""Rules, root causes, vocabularies, expected schemas and gate settings (R15, R16, CL7, D1)."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import MISSING, dataclass, field, fields
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from gaugeframe.session import local_frame

# The issue type each rule type raises.
ISSUE_TYPES = {
    "NULL_PERCENTAGE": "missing",
    "PATTERN": "invalid",
    "DATE_RANGE": "invalid",
    "NON_NEGATIVE_COUNTS": "invalid",
    "TIMESTAMP_ORDER": "inconsistency",
    "ENUM": "invalid",
    "UNIQUE_MAPPING": "inconsistency",
    "DUPLICATE_PERCENTAGE": "duplicate",
    "FK": "orphan",
}


# A path (read by Spark where a session is given) or what such a file would hold.
Source = str | Path | Mapping[str, Any]


def read_yaml(path: str | Path, spark: SparkSession | None = None) -> dict[str, Any]:
    """A YAML file; with a session, from any store that Spark reads."""
    try:
        import yaml
    except ImportError as missing:
        raise RuntimeError("Reading YAML configuration needs the PyYAML package") from missing
    if spark is None:
        text = Path(path).read_text(encoding="utf-8")
    else:
        text = spark.read.text(str(path), wholetext=True).first().value
    return yaml.safe_load(text) or {}


def _content(source: Source, spark: SparkSession | None) -> Mapping[str, Any]:
    return source if isinstance(source, Mapping) else read_yaml(source, spark)


def _section(raw: object, name: str) -> Mapping[str, Any]:
    found = raw.get(name) if isinstance(raw, Mapping) else None
    return found if isinstance(found, Mapping) else {}


def parse_rule_text(rule: str | Mapping[str, Any]) -> tuple[str, tuple[str, ...]]:
    """`NAME(arg, ...)`, or a mapping with `type` and `args`.

    A PATTERN argument is taken whole, so that its regular expression may hold commas.
    """
    if isinstance(rule, Mapping):
        return str(rule["type"]), tuple(str(a) for a in rule.get("args") or ())
    name, bracket, rest = rule.strip().partition("(")
    if not bracket or not rest.endswith(")"):
        return rule.strip(), ()
    inner = rest[:-1]
    pieces = [inner] if name.strip().upper() == "PATTERN" else inner.split(",")
    return name, tuple(p.strip() for p in pieces if p.strip())


def _setting(*keys: str, read: Callable[[Any], Any], default: Any = MISSING) -> Any:
    """A field that configuration holds under the first of `keys` with a value; dots nest."""
    return field(default=default, metadata={"keys": keys, "read": read})


def _configured(kind: type, entry: Mapping[str, Any], **given: Any) -> Any:
    """A `kind` from the settings that `entry` has; the others keep their defaults."""
    for f in fields(kind):
        for key in f.metadata.get("keys", ()):
            *path, last = key.split(".")
            holder = entry
            for step in path:
                holder = _section(holder, step)
            value = holder.get(last)
            if value not in (None, "", []):
                given.setdefault(f.name, f.metadata["read"](value))
    return kind(**given)


def _names(value: str | Iterable[str]) -> tuple[str, ...]:
    return (value,) if isinstance(value, str) else tuple(value)


@dataclass(frozen=True)
class RootCause:
    """A likely cause of one check's failures and its remedy."""

    check_id: str
    probable_cause: str = _setting("probable_cause", read=str, default="")
    recommended_fix: str = _setting("recommended_fix", read=str, default="")


@dataclass(frozen=True)
class Rule:
    """One declared check; its fields say where a rule file holds them."""

    id: str = _setting("id", read=str)
    table: str = _setting("table", read=str)
    dimension: str
    rule_type: str = _setting("rule", read=lambda rule: parse_rule_text(rule)[0])
    args: tuple[str, ...] = _setting("rule", read=lambda rule: parse_rule_text(rule)[1], default=())
    columns: tuple[str, ...] = _setting("columns", "column", read=_names, default=())
    column_regex: str | None = _setting("column_regex", read=str, default=None)
    description: str = _setting("description", read=str, default="")
    severity: int = _setting("severity", read=int, default=1)
    weight: float = _setting("weight", read=float, default=1.0)
    warning: float = _setting("threshold.warning", read=float, default=0.0)
    fail: float = _setting("threshold.fail", read=float, default=0.0)

    @property
    def kind(self) -> str:
        return self.rule_type.upper()

    @property
    def issue_type(self) -> str:
        return ISSUE_TYPES.get(self.kind, "invalid")


@dataclass(frozen=True)
class RuleSet:
    """Rules, the causes known for them (joined on the check id) and the score's bounds."""

    rules: tuple[Rule, ...]
    baseline: float = _setting("score.baseline", read=float, default=100.0)
    minimum: float = _setting("score.min", read=float, default=0.0)
    causes: tuple[RootCause, ...] = ()

    def __iter__(self):
        return iter(self.rules)

    def only(self, *check_ids: str) -> "RuleSet":
        keep = tuple(r for r in self.rules if r.id in check_ids)
        return RuleSet(keep, self.baseline, self.minimum, self.causes)

    def causes_of(self, check_id: str) -> tuple[RootCause, ...]:
        return tuple(cause for cause in self.causes if cause.check_id == check_id)


@dataclass(frozen=True)
class Vocabulary:
    """Alias to canonical value, per domain (CL7)."""

    canonical: Mapping[tuple[str, str], str] = field(default_factory=dict)

    def domain(self, name: str) -> dict[str, str]:
        return {alias: value for (domain, alias), value in self.canonical.items() if domain == name}

    @property
    def states(self) -> dict[str, str]:
        return self.domain("state")

    @property
    def grades(self) -> dict[str, str]:
        return self.domain("grade_band")

    @property
    def districts(self) -> dict[str, str]:
        return self.domain("district")

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(*key, value) for key, value in self.canonical.items()]
        return local_frame(spark, rows, "domain string, alias string, canonical string")


@dataclass(frozen=True)
class GateSettings:
    score_threshold: float = _setting("score_threshold", read=float, default=90.0)
    critical_severity: float = _setting("critical_severity", read=float, default=5.0)


def load_root_causes(source: Source, spark: SparkSession | None = None) -> tuple[RootCause, ...]:
    """One row per cause, in file order; entries lacking a cause or a fix are dropped."""
    listed = (
        (check_id, entry)
        for check_id, value in _section(_content(source, spark), "checks").items()
        for entry in (value if isinstance(value, list) else [value])
        if isinstance(entry, Mapping)
    )
    causes = (_configured(RootCause, entry, check_id=check_id) for check_id, entry in listed)
    return tuple(c for c in causes if c.probable_cause and c.recommended_fix)


def load_rules(
    source: Source, causes: Iterable[RootCause] = (), spark: SparkSession | None = None
) -> RuleSet:
    """Rules from a YAML file or an equal mapping."""
    raw = _content(source, spark)
    rules = tuple(
        _configured(Rule, entry, dimension=dimension)
        for dimension, entries in _section(raw, "checks").items()
        for entry in entries or ()
    )
    return _configured(RuleSet, raw, rules=rules, causes=tuple(causes))


# Spellings every deployment knows, beside the configured ones.
BUILT_IN_STATES = {"ca": "CA", "cax": "CA", "nyc": "NY", "texas": "TX"}


def vocabulary_rows(raw: Mapping[str, Any]) -> Iterator[tuple[str, str, str]]:
    """CL7: domain, spelling and canonical value, the spellings as they are configured."""
    yield from (("state", alias, code) for alias, code in BUILT_IN_STATES.items())
    for code, name in _section(raw, "state_codes").items():
        yield "state", code, code
        yield "state", name, code
    for band, spec in _section(raw, "grade_bands").items():
        yield "grade_band", band, band.strip()
        yield from (("grade_band", word, band.strip()) for word in spec.get("synonyms") or ())
    for alias, name in _section(raw, "district_overrides").items():
        yield "district", alias, name.strip()


def load_vocabulary(source: Source, spark: SparkSession | None = None) -> Vocabulary:
    """CL7: aliases without case or outer spaces; the last row of an alias counts."""
    rows = vocabulary_rows(_content(source, spark))
    return Vocabulary({(domain, alias.strip().lower()): value for domain, alias, value in rows})


def load_expected_schema(source: Source, spark: SparkSession | None = None) -> dict[str, dict[str, str]]:
    """Table -> column -> declared type."""
    tables = _section(_content(source, spark), "tables")
    return {
        table: {
            column: str(spec.get("type", "")) if isinstance(spec, Mapping) else str(spec)
            for column, spec in (payload.get("columns") or {}).items()
        }
        for table, payload in tables.items()
    }


def load_gate_settings(source: Source, spark: SparkSession | None = None) -> GateSettings:
    return _configured(GateSettings, _content(source, spark))
