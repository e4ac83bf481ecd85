"""Laundered names: lower-case ASCII letters, digits and underscores."""

import re

from pyspark.sql import Column, functions as F

# Longest identifier in bytes, and the prefix for a leading digit.
NAME_BYTES = 63
DIGIT_PREFIX = "n"
# Every octet that a laundered name may not contain.
UNSAFE = "".join(c for c in map(chr, range(256)) if not re.match("[0-9a-z]", c))


def launder(name: Column) -> Column:
    """Launder a string column; every byte outside [0-9a-z] becomes ``_``."""
    octets = F.lower(F.decode(F.encode(name, "UTF-8"), "ISO-8859-1"))
    safe = F.translate(octets, UNSAFE, "_" * len(UNSAFE))
    prefix = F.when(F.substring(name, 1, 1).between("0", "9"), F.lit(DIGIT_PREFIX)).otherwise(F.lit(""))
    return F.substring(F.concat(prefix, safe), 1, NAME_BYTES)


def launder_name(name: str) -> str:
    """The same rule for one name of a schema held on the driver."""
    octets = name.encode("utf-8").decode("iso-8859-1").lower()
    safe = re.sub("[^a-z0-9]", "_", octets)
    return (DIGIT_PREFIX * bool(re.match("[0-9]", safe)) + safe)[:NAME_BYTES]
