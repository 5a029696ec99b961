"""Spark-native curation of self-describing JSON exports."""

from recordloom.operators.schema import build_schema
from recordloom.plans.curation import Curation, Staged, curate, run, stage
from recordloom.plans.profiles import VEHICLE_REGISTRATIONS, Profile
from recordloom.sinks.table import iceberg_conf, recover_table, write_table
from recordloom.sources.admission import admission
from recordloom.sources.envelope import Export

__all__ = [
    "VEHICLE_REGISTRATIONS",
    "Curation",
    "Export",
    "Profile",
    "Staged",
    "admission",
    "build_schema",
    "curate",
    "iceberg_conf",
    "recover_table",
    "run",
    "stage",
    "write_table",
]
