"""Node ids and link-local addresses as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The border router's id and its address when the report names none.
ROOT_ID = 1
ROOT_ADDRESS = "fe80::201:1:1:1"

# Fixed patterns: the address form that carries a node id three times (the digits after its zeros, as many as a long holds,
# are a group of their own), and the DODAG form of a root.
NODE_ADDRESS = r"(?i)::[0-9a-f]+:(0*([0-7]?[0-9a-f]{1,15})):\1:\1$"
ROOT_ADDRESS_FORM = r"(?i)::[0-9a-f]+:1:1:1$"


def node_id_from_address(address: Column) -> Column:
    """Node id carried by an address, null when the address has another form or the id no long holds it."""
    # No match gives an empty text, and that converts to null.
    return F.conv(F.regexp_extract(address, NODE_ADDRESS, 2), 16, 10).try_cast("bigint")


def root_address(dodag_id: Column) -> Column:
    return F.when(dodag_id.rlike(ROOT_ADDRESS_FORM), dodag_id).otherwise(F.lit(ROOT_ADDRESS))


def link_local_from_lladdr(lladdr: Column) -> Column:
    """Link-local address of a 16-hex-digit link-layer address (universal/local bit flipped)."""
    def hextet(number: int) -> Column:
        return F.conv(F.substring(lladdr, 1 + 4 * number, 4), 16, 10).cast("int")

    parts = [hextet(0).bitwiseXOR(F.lit(0x0200)), hextet(1), hextet(2), hextet(3)]
    text = F.concat_ws(":", F.lit("fe80:"), *[F.lower(F.hex(p)) for p in parts])
    # Leading zero groups belong to the compressed run.
    return F.when(lladdr.rlike("^[0-9a-fA-F]{16}$"), F.regexp_replace(text, "^fe80::(0:)+", "fe80::"))


def is_link_local(address: Column) -> Column:
    return F.lower(address).startswith("fe80:")
