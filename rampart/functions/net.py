"""IP address arithmetic on string columns.

IPv4 becomes a bigint, IPv6 a 32-digit hex string, so that "inside a network"
is a plain range comparison in both families.
"""

from __future__ import annotations

from rampart.functions.text import literal

# Networks counted as internal for traffic direction.
INTERNAL_NETWORKS = [
    "10.0.0.0/8",
    "172.16.0.0/12",
    "192.168.0.0/16",
    "127.0.0.0/8",
    "169.254.0.0/16",
]

# Address blocks registered as not globally reachable (IANA special
# purpose registries), and the exceptions carved out of them.
PRIVATE_IPV4 = [
    "0.0.0.0/8",
    "10.0.0.0/8",
    "127.0.0.0/8",
    "169.254.0.0/16",
    "172.16.0.0/12",
    "192.0.0.0/24",
    "192.0.2.0/24",
    "192.168.0.0/16",
    "198.18.0.0/15",
    "198.51.100.0/24",
    "203.0.113.0/24",
    "240.0.0.0/4",
]
PUBLIC_IPV4_EXCEPTIONS = ["192.0.0.9/32", "192.0.0.10/32"]
PRIVATE_IPV6 = [
    "::/127",
    "::ffff:0:0/96",
    "64:ff9b:1::/48",
    "100::/64",
    "2001::/23",
    "2001:db8::/32",
    "2002::/16",
    "fc00::/7",
    "fe80::/10",
]
PUBLIC_IPV6_EXCEPTIONS = [
    "2001:1::1/128",
    "2001:1::2/128",
    "2001:3::/32",
    "2001:4:112::/48",
    "2001:20::/28",
    "2001:30::/28",
]

_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4_SYNTAX = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"


def _bounds(network: str) -> tuple[int, int, bool]:
    import ipaddress

    net = ipaddress.ip_network(network)
    return int(net.network_address), int(net.broadcast_address), net.version == 6


def ipv4_bounds(network: str) -> tuple[int, int]:
    """First and last address of an IPv4 network as integers."""
    low, high, is_v6 = _bounds(network)
    if is_v6:
        raise ValueError(f"not an IPv4 network: {network}")
    return low, high


def ipv4_long_sql(ip: str) -> str:
    """Dotted quad to bigint; NULL for anything else (leading zeros included)."""
    part = [
        f"substring_index({ip}, '.', 1)",
        f"substring_index(substring_index({ip}, '.', 2), '.', -1)",
        f"substring_index(substring_index({ip}, '.', 3), '.', -1)",
        f"substring_index({ip}, '.', -1)",
    ]
    total = " + ".join(
        f"CAST({p} AS BIGINT) * {256 ** (3 - i)}L" for i, p in enumerate(part)
    )
    return f"CASE WHEN {ip} RLIKE {literal(IPV4_SYNTAX)} THEN {total} END"


def ipv6_hex_sql(ip: str) -> str:
    """IPv6 text to 32 lower-case hex digits; NULL when it is not IPv6.

    Handles ``::`` compression, an embedded dotted quad and a ``%scope``.
    """
    address = f"substring_index({ip}, '%', 1)"
    quad = f"substring_index({address}, ':', -1)"
    quad_long = ipv4_long_sql("q")
    # A trailing dotted quad is rewritten as two groups first.
    rewritten = (
        f"CASE WHEN contains({quad}, '.') THEN"
        f" get(transform(array({quad}), q -> concat("
        f"left({address}, length({address}) - length(q)),"
        f" lower(hex(shiftright({quad_long}, 16))), ':',"
        f" lower(hex(({quad_long}) & 65535L)))), 0)"
        f" ELSE lower({address}) END"
    )
    groups = "filter(split(side, ':'), g -> g <> '')"
    sides = f"transform(split(a, '::'), side -> {groups})"
    padded = "transform({0}, g -> lpad(g, 4, '0'))"
    head, tail = "get(s, 0)", "coalesce(get(s, 1), array())"
    filled = (
        f"concat(array_join({padded.format(head)}, ''),"
        f" repeat('0000', 8 - size({head}) - size({tail})),"
        f" array_join({padded.format(tail)}, ''))"
    )
    shape = r"^([0-9a-f]{1,4}(:[0-9a-f]{1,4})*)?(::([0-9a-f]{1,4}(:[0-9a-f]{1,4})*)?)?$"
    return (
        f"CASE WHEN contains({ip}, ':') AND NOT {ip} RLIKE '%$|%.*%' THEN"
        f" get(transform(array({rewritten}), a -> CASE WHEN a RLIKE {literal(shape)} THEN"
        f" get(transform(array({sides}), s -> CASE"
        f" WHEN contains(a, '::') AND size({head}) + size({tail}) <= 7 THEN {filled}"
        f" WHEN NOT contains(a, '::') AND size({head}) = 8 THEN {filled} END), 0) END), 0) END"
    )


def in_networks_sql(value: str, networks: list[str]) -> str:
    """Range test of an address against a short list of networks."""
    tests = []
    for network in networks:
        low, high, is_v6 = _bounds(network)
        if is_v6:
            tests.append(f"{value} BETWEEN '{low:032x}' AND '{high:032x}'")
        else:
            tests.append(f"{value} BETWEEN {low}L AND {high}L")
    return "(" + " OR ".join(tests) + ")"


def internal_sql(ipv4: str) -> str:
    """Is the (bigint) address internal?  NULL address: false."""
    return f"coalesce({in_networks_sql(ipv4, INTERNAL_NETWORKS)}, false)"


def private_sql(ipv4: str, ipv6: str) -> str:
    """Is the address outside the global internet?  NULL addresses: false."""
    return (
        f"coalesce({in_networks_sql(ipv4, PRIVATE_IPV4)}"
        f" AND NOT {in_networks_sql(ipv4, PUBLIC_IPV4_EXCEPTIONS)}, false)"
        f" OR coalesce({in_networks_sql(ipv6, PRIVATE_IPV6)}"
        f" AND NOT {in_networks_sql(ipv6, PUBLIC_IPV6_EXCEPTIONS)}, false)"
    )


def halves_sql(ipv4: str, ipv6: str) -> tuple[str, str]:
    """The upper and lower 64 bits of an address (bigint, or hex) as bigints."""

    def half(start: int) -> str:
        return f"CAST(conv(substring({ipv6}, {start}, 16), 16, -10) AS BIGINT)"

    return f"CASE WHEN {ipv4} IS NOT NULL THEN 0L ELSE {half(1)} END", f"coalesce({ipv4}, {half(17)})"


def masked_sql(high: str, low: str, bits: str) -> tuple[str, str]:
    """Both halves with all but the first ``bits`` of the 128 bits cleared."""
    upper = f"CASE WHEN {bits} <= 0 THEN 0L WHEN {bits} >= 64 THEN {high} ELSE {high} & shiftleft(-1L, 64 - {bits}) END"
    lower = f"CASE WHEN {bits} <= 64 THEN 0L WHEN {bits} >= 128 THEN {low} ELSE {low} & shiftleft(-1L, 128 - {bits}) END"
    return upper, lower
