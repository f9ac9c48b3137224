"""Write, audit, publish: a publish counts only if the audit could have failed."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.frames import one_row
from tidemark.operators.audit import AuditOutcome, run_audit
from tidemark.operators.probe import probe
from tidemark.operators.twins import lookahead_twin, require_twin_destination
from tidemark.plans.lake import Lake
from tidemark.sources.tables import MissingTable, VersionedTable

POINTER_SCHEMA = "name string, root string, version bigint"


class Published:
    """A small pointer table naming the gold version consumers read."""

    def __init__(self, spark, root: str, name: str = "gold"):
        self.spark, self.name, self.pointers = spark, name, VersionedTable(spark, root)

    def point_to(self, table: VersionedTable, version: int) -> None:
        row = one_row(self.spark, (self.name, table.root, version), POINTER_SCHEMA)
        self.pointers.merge(row, ["name"], num_source=1, source_unique=True)

    def read(self) -> DataFrame:
        at = self.pointers.read().filter(F.col("name") == self.name).first()
        if at is None:
            raise MissingTable(f"nothing published as {self.name}")
        return VersionedTable(self.spark, at["root"]).read(at["version"])


@dataclass(frozen=True)
class PublishRecord:
    candidate: AuditOutcome
    twin: AuditOutcome
    planted: int
    control_passed: bool
    probe_passed: bool
    published: bool

    @property
    def credited(self) -> bool:
        return self.published and self.probe_passed and not self.control_passed

    def frame(self, spark) -> DataFrame:
        row = (
            self.candidate.verdict,
            self.twin.verdict,
            self.planted,
            self.twin.count("A1"),
            self.control_passed,
            self.probe_passed,
            self.published,
            self.credited,
        )
        return one_row(
            spark,
            row,
            "candidate string, twin string, planted bigint, twin_a1 bigint, "
            "control_passed boolean, probe_passed boolean, published boolean, credited boolean",
        )


def write_audit_publish(
    lake: Lake,
    published: Published,
    twin_root: str,
    defect: Column,
    key: Mapping[str, object],
    at: str,
    expect,
    years: int = 5,
) -> PublishRecord:
    """Publish the lake's current gold after it earned it.

    The same audit must pass on the candidate and fail on a twin with exactly
    the planted rows, all other checks unchanged; the consumer probe must fail before the publish and pass
    after it.  An unevaluable or red candidate is never published.
    """
    require_twin_destination(twin_root)
    spark, model = lake.spark, lake.model
    version = lake.gold.latest_version()
    if version is None:
        raise MissingTable("no gold candidate to publish")
    candidate = lake.gold.read(version)
    registry = lake.registry.read() if lake.registry.exists() else None
    green = run_audit(candidate, model, registry)

    twin = VersionedTable(spark, twin_root)
    twin.overwrite(lookahead_twin(candidate, model, defect, years))
    planted = candidate.filter(defect).count()
    red = run_audit(twin.read(), model, registry)

    control, _ = probe(_open(published), model, key, at, expect)
    # the planted defect must show, and nothing but it
    others = lambda o: [(r.check, r.verdict, r.violations) for r in o.results if r.check[:2] != "A1"]
    earned = green.verdict == "GREEN" and red.verdict == "RED"
    earned = earned and red.count("A1") == planted and others(green) == others(red)
    if earned:
        published.point_to(lake.gold, version)
    after, _ = probe(_open(published), model, key, at, expect)
    return PublishRecord(green, red, planted, control, after, earned)


def _open(published: Published) -> DataFrame | Exception:
    try:
        return published.read()
    except Exception as e:  # an absent table is the control's expected sight
        return e
