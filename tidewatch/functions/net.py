"""IP address functions and the network lookup join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.text import strip

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_V4 = rf"{_OCTET}(?:\.{_OCTET}){{3}}"
_H = "[0-9A-Fa-f]{1,4}"
_V6_FORMS = [
    f"(?:{_H}:){{7}}{_H}",
    f"(?:{_H}:){{1,7}}:",
    *(f"(?:{_H}:){{1,{7 - k}}}(?::{_H}){{1,{k}}}" for k in range(1, 7)),
    f":(?:(?::{_H}){{1,7}}|:)",
    f"(?:{_H}:){{6}}{_V4}",
    f"::(?:{_H}:){{0,5}}{_V4}",
    *(f"(?:{_H}:){{1,{k}}}(?::{_H}){{0,{5 - k}}}:{_V4}" for k in range(1, 6)),
]
IPV4_REGEX = rf"\A{_V4}\z"
IPV6_REGEX = rf"\A(?:{'|'.join(_V6_FORMS)})(?:%[^%]+)?\z"

# 10/8, 172.16/12, 192.168/16, 127/8 and fc00::/7.
PRIVATE_V4_REGEX = r"\A(?:10\.|127\.|192\.168\.|172\.(?:1[6-9]|2[0-9]|3[01])\.)"
PRIVATE_V6_REGEX = r"\A[Ff][CcDd][0-9A-Fa-f]{2}:"


def is_valid_ipv4(ip: Column) -> Column:
    return F.coalesce(ip.rlike(IPV4_REGEX), F.lit(False))


def is_valid_ip(ip: Column) -> Column:
    """True for an IPv4 or IPv6 address written without surrounding blanks."""
    return F.coalesce(
        F.when(ip.contains(":"), ip.rlike(IPV6_REGEX)).otherwise(ip.rlike(IPV4_REGEX)), F.lit(False)
    )


def normalize_ip(ip: Column) -> Column:
    bare = strip(ip)
    return F.when(is_valid_ip(bare), bare)


def is_private_ip(ip: Column) -> Column:
    private = F.when(ip.contains(":"), ip.rlike(PRIVATE_V6_REGEX)).otherwise(ip.rlike(PRIVATE_V4_REGEX))
    return is_valid_ip(ip) & private


def _let(value: Column, use) -> Column:
    """``use`` applied to a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _hextets(text: Column) -> Column:
    return F.when(
        text == "", F.array().cast("array<string>")
    ).otherwise(F.transform(F.split(text, ":"), lambda h: F.lpad(h, 4, "0")))


def _v4_hex(text: Column) -> Column:
    return F.array_join(
        F.transform(F.split(text, r"\."), lambda o: F.lpad(F.lower(F.hex(o.cast("int"))), 2, "0")), ""
    )


def _v6_hex(text: Column) -> Column:
    tail = r"\d+\.\d+\.\d+\.\d+\z"

    def without_tail(t):
        low = _let(
            _v4_hex(F.regexp_extract(t, tail, 0)),
            lambda h: F.concat(F.substring(h, 1, 4), F.lit(":"), F.substring(h, 5, 4)),
        )
        return F.when(t.rlike(tail), F.concat(F.regexp_replace(t, tail, ""), low)).otherwise(t)

    def fill_gap(sides):
        gap = F.array_repeat(F.lit("0000"), F.lit(8) - F.size(sides["l"]) - F.size(sides["r"]))
        return F.array_join(F.concat(sides["l"], gap, sides["r"]), "")

    def both_sides(halves):
        return F.struct(
            _hextets(F.get(halves, F.lit(0))).alias("l"),
            _hextets(F.coalesce(F.get(halves, F.lit(1)), F.lit(""))).alias("r"),
        )

    return _let(_let(F.split(_let(text, without_tail), "::"), both_sides), fill_gap)


def ip_hex(ip: Column) -> Column:
    """Sortable hex form: 8 digits for IPv4, 32 for IPv6, null if invalid."""
    bare = F.lower(F.regexp_replace(ip, "%.*", ""))
    return F.when(is_valid_ip(ip), F.when(ip.contains(":"), _v6_hex(bare)).otherwise(_v4_hex(ip)))


def _fill(prefix_hex: Column, bits: Column, width: Column, ones: bool) -> Column:
    """``prefix_hex`` with every bit after the first ``bits`` cleared or set."""
    whole = F.floor(bits / 4).cast("int")
    partial = bits % 4
    nibble = F.conv(F.substring(prefix_hex, whole + 1, F.lit(1)), 16, 10).cast("int")
    step = F.pow(F.lit(2), 4 - partial).cast("int")
    edge = F.floor(nibble / step).cast("int") * step + (step - 1 if ones else F.lit(0))
    kept = F.concat(
        F.substring(prefix_hex, F.lit(1), whole),
        F.when(partial > 0, F.lower(F.hex(edge))).otherwise(F.lit("")),
    )
    return F.rpad(kept, width, F.lit("f" if ones else "0"))


def network_ranges(networks: DataFrame, cidr: str = "cidr") -> DataFrame:
    """Add ``net_lo``, ``net_hi`` (hex bounds) and ``net_nibbles`` to a table of CIDR strings."""
    base = F.split(F.col(cidr), "/")
    # through a generator, so that the address is converted once
    parsed = networks.select(
        "*", F.inline(F.array(F.struct(ip_hex(F.get(base, F.lit(0))).alias("_hex"), F.get(base, F.lit(1)).cast("int").alias("_len"))))
    )
    width = F.length("_hex")
    bits = F.coalesce("_len", width * 4)
    return parsed.select(
        *networks.columns,
        _fill(F.col("_hex"), bits, width, False).alias("net_lo"),
        _fill(F.col("_hex"), bits, width, True).alias("net_hi"),
        F.floor(bits / 4).cast("int").alias("net_nibbles"),
    )


#: Prefixes of at most so many hex digits are salted; there are fewer than 300 of them.
SHORT_NIBBLES = 2
SALTS = 64


def match_networks(df: DataFrame, ip: str, networks: DataFrame, cidr: str = "cidr") -> DataFrame:
    """All (address, network) matches, one row per distinct address and network.

    A range join without a nested loop: each distinct address is looked up once per whole-nibble
    prefix length that occurs among the networks (33 at most), by equality on that prefix, and the
    remaining bits are compared on the few candidates.
    """
    nets = network_ranges(networks, cidr).select(
        cidr, "net_lo", "net_hi", "net_nibbles",
        F.length("net_lo").alias("net_width"),
        F.expr("substring(net_lo, 1, net_nibbles)").alias("net_prefix"),
    )
    lengths = nets.select("net_width", "net_nibbles").distinct()
    # the generator keeps the conversion from being repeated in the conditions below
    addresses = df.select(ip).distinct().select(ip, F.explode(F.array(ip_hex(F.col(ip)))).alias("_hex"))
    addresses = addresses.where("_hex IS NOT NULL")
    # at most 9 + 33 rows by the width of an address
    keyed = addresses.join(F.broadcast(lengths), F.length("_hex") == F.col("net_width")).withColumn(
        "net_prefix", F.expr("substring(_hex, 1, net_nibbles)")
    )
    # a short prefix is that of very many addresses: these are dealt over salts, and its few networks repeated
    short = F.col("net_nibbles") <= SHORT_NIBBLES
    keyed = keyed.withColumn("_salt", F.when(short, F.pmod(F.xxhash64("_hex"), F.lit(SALTS))).otherwise(0).cast("int"))
    nets = nets.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.when(short, SALTS - 1).otherwise(0))))
    return (
        keyed.join(nets, ["net_width", "net_nibbles", "net_prefix", "_salt"])
        .where("_hex BETWEEN net_lo AND net_hi")
        .select(ip, cidr, "net_nibbles", "net_lo")
    )
