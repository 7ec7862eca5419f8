"""Devices, their owners' addresses and the devices nobody owns.

Joins here carry no broadcast hint: the device tables grow with the fleet, so
Catalyst broadcasts them while their size estimate is under the session's
threshold and sort-merges (with skew splitting for a hot device) beyond it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetledger.functions import scalars
from fleetledger.operators.ordering import number_rows

DEVICE, ADDRESS = "k_dispositivo", "celo_address"
Derive = Callable[[Column], Column]

# Device names per alert text.
ALERT_DEVICES = 1_000


class DeviceConflict(ValueError):
    """A device is claimed more than once."""


def owned_devices(contacts: DataFrame, derive: Derive = scalars.placeholder_address) -> DataFrame:
    """One row per claim: contact, device, and the own or derived address."""
    own = scalars.non_empty("fields.celo_address")
    return contacts.select(
        "id", F.explode("fields.gps_id_list").alias(DEVICE),
        F.coalesce(own, derive(F.col("fields.client_id"))).alias(ADDRESS))


def build_map(contacts: DataFrame, derive: Derive = scalars.placeholder_address) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Device to address map, address updates for the contacts, and devices claimed twice.

    A device claimed more than once is in the conflicts and not in the map.
    """
    claims = owned_devices(contacts, derive).groupBy(DEVICE).agg(
        F.expr("count(1) as claims"), F.expr(f"min({ADDRESS}) as {ADDRESS}"))
    device_map = claims.where("claims = 1").select(DEVICE, ADDRESS)
    conflicts = claims.where("claims > 1").select(DEVICE, "claims")
    updates = contacts.where(
        (F.size("fields.gps_id_list") > 0) & scalars.non_empty("fields.celo_address").isNull()
    ).select("id", derive(F.col("fields.client_id")).alias(ADDRESS))
    return device_map, updates, conflicts


def require_no_conflicts(conflicts: DataFrame) -> None:
    """The gate before a map is written."""
    found = [r[0] for r in conflicts.select(DEVICE).limit(10).collect()]
    if found:
        raise DeviceConflict(f"devices claimed by more than one contact entry, such as: {', '.join(found)}")


def attach(routes: DataFrame, device_map: DataFrame) -> DataFrame:
    """Add each route's address; null where the device has no owner."""
    return routes.join(device_map.select(DEVICE, ADDRESS), DEVICE, "left")


def override(routes: DataFrame, prototypes: DataFrame, address: str | Column) -> DataFrame:
    """Give listed prototype devices a fixed address, only where none is known."""
    listed = prototypes.select(DEVICE).distinct().withColumn("_listed", F.lit(True))
    fill = F.lit(address) if isinstance(address, str) else address
    return (
        routes.join(listed, DEVICE, "left")
        .withColumn(ADDRESS, F.when(F.col("_listed") & F.col(ADDRESS).isNull(), fill).otherwise(F.col(ADDRESS)))
        .drop("_listed"))


def missing_address(routes: DataFrame) -> DataFrame:
    return routes.where(F.col(ADDRESS).isNull())


def known_unassigned(routes: DataFrame, known: DataFrame) -> DataFrame:
    """Listed devices that do miss an address in these routes; assigned ones fall out of the list."""
    missing = missing_address(routes).select(DEVICE).distinct()
    return known.select(DEVICE).distinct().join(missing, DEVICE, "left_semi")


def drop_devices(routes: DataFrame, devices: DataFrame) -> DataFrame:
    """Rows of other devices; rows with no device stay."""
    return routes.join(devices.select(DEVICE), DEVICE, "left_anti")


def unassigned(routes: DataFrame, known: DataFrame, *by: str) -> DataFrame:
    """Distinct devices that miss an address and are not on the known list: those to alert on."""
    missing = missing_address(routes).select(*by, DEVICE).distinct()
    return missing.join(known.select(DEVICE), DEVICE, "left_anti").select(*by, DEVICE)


def alert_texts(devices: DataFrame, *by: str, per_text: int = ALERT_DEVICES) -> DataFrame:
    """Join device names into alert texts of at most ``per_text`` names, in order, all names kept.

    For the mail only: what is stored is a row per device. Names are numbered over all
    groups at once, so no task sorts a whole group.
    """
    named = devices.select(*by, DEVICE).where(F.col(DEVICE).isNotNull()).distinct()
    numbered = number_rows(named, [*by, DEVICE], "_n")
    first = numbered.groupBy(*by).agg(F.min("_n").alias("_first")).withColumnsRenamed({c: f"_{c}" for c in by})
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    part = F.floor((F.col("_n") - F.col("_first")) / per_text).cast("bigint")
    return (
        numbered.join(first, same).withColumn("part", part).groupBy(*by, "part")
        .agg(F.count(F.lit(1)).alias("devices"), F.array_join(F.sort_array(F.collect_list(DEVICE)), ", ").alias("device_list")))


def device_table(device_map: DataFrame, prototypes: DataFrame | None, known: DataFrame | None) -> DataFrame:
    """One row per device with its address and list memberships.

    Lets a route table meet all device lists in one join instead of three.
    """
    every = device_map.selectExpr(DEVICE, ADDRESS, "false as is_prototype", "false as is_known")
    none = f"cast(null as string) as {ADDRESS}"
    if prototypes is not None:
        every = every.union(prototypes.selectExpr(DEVICE, none, "true as is_prototype", "false as is_known"))
    if known is not None:
        every = every.union(known.selectExpr(DEVICE, none, "false as is_prototype", "true as is_known"))
    return every.groupBy(DEVICE).agg(
        *[F.expr(f"max({c}) as {c}") for c in (ADDRESS, "is_prototype", "is_known")])
