"""Job options."""

from __future__ import annotations

from dataclasses import dataclass, field

from .errors import JobError

# Fixed value: longest time limit of a query, in seconds.
MAX_TIMEOUT_S = 86_400

# Option names that are accepted and have no effect here.
IGNORED_OPTIONS = ("advancedMode", "retries", "maxTriesBcp", "disableBcp", "disableFallback", "id")


def bounded_timeout(seconds: int | None) -> int | None:
    """A time limit by its size, within a day; 0 is none."""
    return min(abs(seconds), MAX_TIMEOUT_S) or None if seconds is not None else None


@dataclass(frozen=True)
class JobSpec:
    """One extract: a table (or view) or a query, and how to pull and write it.

    With ``exactly_once`` rows at the state's watermark that earlier runs have written do not come again.
    """

    output: str
    table: str | None = None
    schema: str | None = None
    query: str | None = None
    columns: list[str] = field(default_factory=list)
    primary_key: list[str] = field(default_factory=list)
    name: str | None = None
    enabled: bool = True
    incremental: bool = False
    watermark: str | None = None
    limit: int | None = None
    exactly_once: bool = False
    read_uncommitted: bool = False
    cdc: bool = False
    cdc_full_load_fallback: bool = False
    timeout_s: int | None = None

    def __post_init__(self):
        if bool(self.query) == bool(self.table):
            raise JobError('Either "query" or "table" must be set.')
        if self.query and self.watermark:
            raise JobError(
                'The "incrementalFetchingColumn" is configured, '
                "but incremental fetching is not supported for custom query."
            )
        if self.cdc and self.query:
            raise JobError("Change capture needs a table.")
        if self.limit and not self.watermark:
            raise JobError('A limit needs an "incrementalFetchingColumn".')
        if self.exactly_once and (not self.watermark or self.columns and self.watermark not in self.columns):
            raise JobError("A pull that sends each row once needs a watermark and has to output it.")
        object.__setattr__(self, "timeout_s", bounded_timeout(self.timeout_s))

    @classmethod
    def from_options(cls, options: dict) -> "JobSpec":
        """A job from its external option names."""
        # External option name and the field it sets.
        names = {
            "outputTable": "output",
            "query": "query",
            "columns": "columns",
            "primaryKey": "primary_key",
            "name": "name",
            "enabled": "enabled",
            "incremental": "incremental",
            "incrementalFetchingColumn": "watermark",
            "incrementalFetchingLimit": "limit",
            "nolock": "read_uncommitted",
            "cdcMode": "cdc",
            "cdcModeFullLoadFallback": "cdc_full_load_fallback",
            "queryTimeout": "timeout_s",
        }
        unknown = set(options) - set(names) - set(IGNORED_OPTIONS) - {"table", "db"}
        if unknown:
            raise JobError(f"Unknown options: {sorted(unknown)}")
        values = {names[k]: v for k, v in options.items() if k in names and v is not None}
        table = options.get("table") or {}
        return cls(table=table.get("tableName"), schema=table.get("schema"), **values)


def jobs_from_options(options: dict) -> list[JobSpec]:
    """The jobs of a configuration: its list of tables, or the one job it is itself.

    A time limit of the connection applies to jobs, and one of a single job to its connection.
    """
    tables = options.get("tables")
    limit = (options.get("db") or {}).get("queryTimeout")
    entries = tables if tables is not None else [options]
    return [JobSpec.from_options({**({"queryTimeout": limit} if limit else {}), **e}) for e in entries]
