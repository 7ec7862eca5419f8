"""The device map job: contacts to map and address updates, behind the conflict gate."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fleetledger.functions import scalars
from fleetledger.operators import devices
from fleetledger.sources import writers


def changes(contacts: DataFrame, derive: devices.Derive = scalars.placeholder_address) -> tuple[DataFrame, DataFrame]:
    """The map and the addresses to write back (id, celo_address); raises when a device is claimed twice."""
    device_map, updates, conflicts = devices.build_map(contacts, derive)
    devices.require_no_conflicts(conflicts)
    return device_map, updates


def sync(contacts: DataFrame, derive: devices.Derive = scalars.placeholder_address) -> tuple[DataFrame, DataFrame]:
    """The map and the contacts with derived addresses; raises when a device is claimed twice."""
    device_map, updates = changes(contacts, derive)
    return device_map, writers.upsert_fields(contacts, updates, ["celo_address"])
