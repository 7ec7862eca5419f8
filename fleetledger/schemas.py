"""Declared schemas: nothing in the library infers a type from data."""

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


LONG, TEXT, REAL, DATE, FLAG = T.LongType(), T.StringType(), T.DoubleType(), T.DateType(), T.BooleanType()
TEXTS = T.ArrayType(TEXT)

ROUTES_RAW = _struct(
    ("k_ruta", LONG), ("k_dispositivo", TEXT),
    ("o_fecha_inicial", TEXT), ("o_fecha_final", TEXT), ("f_distancia", REAL),
    ("Referencia", TEXT),
    ("lng_inicial", LONG), ("lat_inicial", LONG), ("lng_final", LONG), ("lat_final", LONG),
    ("source", TEXT), ("date", DATE),
)

ROUTES_FINAL = _struct(
    ("routeid", LONG), ("gpsid", TEXT), ("timestampstart", LONG), ("timestampend", LONG),
    ("measureddistance", LONG), ("celo_address", TEXT), ("date", DATE), ("source", TEXT),
)

ID_ASSIGNMENTS = _struct(
    ("k_ruta", LONG), ("segment", LONG), ("params_version", TEXT), ("route_id", LONG), ("date", DATE), ("source", TEXT))
ID_MARKS = _struct(("run", TEXT), ("start", LONG), ("mark", LONG))

CONTACTS = _struct(
    ("id", TEXT),
    ("fields", _struct(("client_id", LONG), ("gps_id_list", TEXTS), ("celo_address", TEXT))),
)

DEVICE_LIST = _struct(("k_dispositivo", TEXT))
DEVICE_MAP = _struct(("k_dispositivo", TEXT), ("celo_address", TEXT))

LEDGER = _struct(
    ("environment", TEXT), ("date", DATE), ("route_id", LONG),
    ("status", TEXT), ("nonce", LONG), ("gas_price", LONG), ("tx_hash", TEXT),
)

ATTEMPTS = _struct(
    ("date", DATE), ("seq", LONG), ("route_id", LONG), ("message", TEXT), ("cost", LONG),
    ("nonce", LONG), ("gas_price", LONG), ("tx_hash", TEXT))

CREDIT_ATTEMPTS = _struct(("seq", LONG), ("credit_id", LONG), ("message", TEXT))

LEDGER_EVENTS = _struct(
    ("event", TEXT), ("block", LONG), ("seq", LONG),
    ("args", _struct(("to", TEXT), ("token_id", LONG), ("timestamp_start", LONG),
                     ("timestamp_end", LONG), ("distance", LONG))),
)

CREDITS_RAW = _struct(
    ("id", TEXT),
    ("fields", _struct(
        ("credit_id", LONG), ("client_link", TEXTS), ("investment", REAL), ("initial_debt", REAL),
        ("disbursed", TEXT), ("term_text", TEXT), ("client_address", TEXTS), ("published_staging", FLAG),
        ("published_production", FLAG))),
)

PAYMENTS_RAW = _struct(
    ("id", TEXT),
    ("fields", _struct(
        ("payment_id", LONG), ("credit_id", LONG), ("amount", REAL), ("payment_date", TEXT),
        ("published_staging", FLAG), ("published_production", FLAG))),
)

CREDITS_STATE = _struct(
    ("credit_id", LONG), ("issuance_date", LONG), ("owner", TEXT), ("principal", LONG), ("outstanding", LONG),
    ("term_days", LONG),
)

PAYMENT_OUTCOMES = _struct(
    ("id", TEXT), ("payment_id", LONG), ("credit_id", LONG), ("amount", LONG), ("payment_date", LONG),
    ("outcome", TEXT), ("applied", LONG), ("balance", LONG), ("records", LONG),
)

# What stores keep: a credit's debt and payments, recorded payment ids, recorded routes, partial sums.
BALANCES = _struct(("credit_id", LONG), ("total_repayment", LONG), ("paid", LONG))
TAKEN = _struct(("payment_id", LONG), ("id", TEXT), ("credit_id", LONG), ("amount", LONG), ("payment_date", LONG))
ROUTE_STATE = _struct(("token_id", LONG), ("block", LONG), ("seq", LONG), ("to", TEXT), ("timestamp_start", LONG),
                      ("timestamp_end", LONG), ("distance", LONG))
ROUTES_PER_DAY = _struct(("date", DATE), ("routes", LONG))
DRIVER_DAYS = _struct(("celo_address", TEXT), ("date", DATE), ("routes", LONG), ("total_seconds", LONG), ("total_distance", LONG))

TRIPS_TAKEN = _struct(("k_ruta", LONG), ("date", DATE), ("source", TEXT), ("batch", LONG))
JOB_COUNTS = _struct(("job", TEXT), ("run", TEXT), ("step", TEXT), ("name", TEXT), ("value", LONG))
LOG_FILES = _struct(("path", TEXT), ("modified", T.TimestampType()), ("least", T.TimestampType()), ("greatest", T.TimestampType()))
