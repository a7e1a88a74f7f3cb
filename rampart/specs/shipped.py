"""Specs of the supported log sources.

Fixed values: identity texts, column names, capture patterns, key mappings and
verb translations as the log sources and the canonical schema define them.
"""

SHIPPED = [
    {
        "id": "palo_alto_traffic",
        "name": "Palo Alto Networks PAN-OS Traffic Parser",
        "vendor": "Palo Alto Networks",
        "product": "PAN-OS Next-Gen Firewall",
        "version": "10.2.0",
        "format": "csv",
        "parser_config": {
            "delimiter": ",",
            "columns": [
                "future_use_1", "receive_time", "serial", "type", "subtype", "future_use_2",
                "time_generated", "src_ip", "dst_ip", "nat_src_ip", "nat_dst_ip", "rule_name",
                "src_user", "dst_user", "app", "vsys", "src_zone", "dst_zone", "inbound_if",
                "outbound_if", "log_profile", "future_use_3", "session_id", "repeat_count",
                "src_port", "dst_port", "nat_src_port", "nat_dst_port", "flags", "protocol",
                "action", "bytes", "bytes_sent", "bytes_received", "packets", "start_time",
                "elapsed", "category",
            ],
        },
        "mapping": {
            "src_endpoint.ip": "src_ip",
            "src_endpoint.port": "src_port",
            "src_endpoint.zone": "src_zone",
            "dst_endpoint.ip": "dst_ip",
            "dst_endpoint.port": "dst_port",
            "dst_endpoint.zone": "dst_zone",
            "connection_info.protocol": "protocol",
            "connection_info.session_id": "session_id",
            "traffic.bytes_in": "bytes_received",
            "traffic.bytes_out": "bytes_sent",
            "traffic.total_bytes": "bytes",
            "traffic.duration_ms": "elapsed",
            "disposition.action": "action",
            "app_name": "app",
            "timestamp": "time_generated",
        },
        "value_maps": {
            "disposition.action": {
                "allow": "Allowed",
                "deny": "Blocked",
                "drop": "Dropped",
                "reset-both": "Reset",
                "reset-client": "Reset",
                "reset-server": "Reset",
            }
        },
    },
    {
        "id": "cisco_asa",
        "name": "Cisco ASA / Firepower Firewall Parser",
        "vendor": "Cisco Systems",
        "product": "Cisco Adaptive Security Appliance (ASA)",
        "version": "9.18",
        "format": "regex",
        "parser_config": {
            "pattern": r"(?:%ASA-(?P<severity_digit>\d)-(?P<msg_id>\d+):\s+)(?P<action_verb>Built|Deny|Teardown)\s+(?:(?P<direction_word>inbound|outbound)\s+)?(?P<protocol>\w+)\s+(?:connection\s+(?P<conn_id>\d+)\s+for\s+(?P<dst_zone>\w+):(?P<dst_ip>[\d\.]+)/(?P<dst_port>\d+)(?:\s+\([^)]+\))?\s+to\s+(?P<src_zone>\w+):(?P<src_ip>[\d\.]+)/(?P<src_port>\d+)|src\s+(?P<src_zone2>\w+):(?P<src_ip2>[\d\.]+)/(?P<src_port2>\d+)\s+dst\s+(?P<dst_zone2>\w+):(?P<dst_ip2>[\d\.]+)/(?P<dst_port2>\d+))"
        },
        "mapping": {
            "src_endpoint.ip": ["src_ip", "src_ip2"],
            "src_endpoint.port": ["src_port", "src_port2"],
            "src_endpoint.zone": ["src_zone", "src_zone2"],
            "dst_endpoint.ip": ["dst_ip", "dst_ip2"],
            "dst_endpoint.port": ["dst_port", "dst_port2"],
            "dst_endpoint.zone": ["dst_zone", "dst_zone2"],
            "connection_info.protocol": "protocol",
            "connection_info.session_id": "conn_id",
            "disposition.action": "action_verb",
            "severity.level": "severity_digit",
            "threat.signature_id": "msg_id",
        },
        "value_maps": {
            "disposition.action": {"built": "Allowed", "deny": "Blocked", "teardown": "Allowed"}
        },
    },
    {
        "id": "cisco_ios",
        "name": "Cisco IOS / IOS-XE Security & Syslog Parser",
        "vendor": "Cisco Systems",
        "product": "Cisco IOS / IOS-XE Network OS",
        "version": "17.x",
        "format": "regex",
        "parser_config": {
            "pattern": r"(?:(?P<seq_num>\d+):\s+)?(?:(?P<timestamp>\d{4}\s+[A-Za-z]{3}\s+\d+\s+[\d:\.]+(?:\s+[A-Z]+)?):\s+)?%(?P<facility>[A-Za-z0-9_]+)-(?P<severity_digit>\d)-(?P<mnemonic>[A-Za-z0-9_]+):\s+(?P<message>.*?)(?:\s+\[user:\s*(?P<user>[^\]]+)\])?(?:\s+\[(?:Source|src):\s*(?P<src_ip>[^\]]+)\])?(?:\s+\[port:\s*(?P<dst_port>\d+)\])?(?:\s+\[(?:Reason|reason):\s*(?P<reason>[^\]]+)\])?$"
        },
        "mapping": {
            "src_endpoint.ip": "src_ip",
            "dst_endpoint.port": "dst_port",
            "disposition.action": "mnemonic",
            "severity.level": "severity_digit",
            "threat.signature_id": "mnemonic",
        },
        "value_maps": {
            "disposition.action": {
                "login_failed": "Blocked",
                "login_success": "Allowed",
                "config_i": "Allowed",
            }
        },
    },
    {
        "id": "fortinet_fortios",
        "name": "Fortinet FortiGate FortiOS Traffic Parser",
        "vendor": "Fortinet",
        "product": "FortiGate Next-Gen Firewall",
        "version": "7.2.0",
        "format": "key_value",
        "mapping": {
            "src_endpoint.ip": "srcip",
            "src_endpoint.port": "srcport",
            "src_endpoint.interface": "srcintf",
            "dst_endpoint.ip": "dstip",
            "dst_endpoint.port": "dstport",
            "dst_endpoint.interface": "dstintf",
            "connection_info.protocol": "proto",
            "connection_info.session_id": "sessionid",
            "traffic.bytes_in": "rcvdbyte",
            "traffic.bytes_out": "sentbyte",
            "traffic.duration_ms": "duration",
            "disposition.action": "action",
            "severity.level": "level",
            "app_name": "app",
            "timestamp": "time",
        },
        "value_maps": {
            "disposition.action": {
                "accept": "Allowed",
                "deny": "Blocked",
                "drop": "Dropped",
                "close": "Allowed",
                "client-rst": "Reset",
                "server-rst": "Reset",
            }
        },
    },
    {
        "id": "suricata_eve",
        "name": "Suricata Network IDS/IPS EVE JSON Parser",
        "vendor": "OISF",
        "product": "Suricata IDS/IPS Engine",
        "version": "7.0",
        "format": "json",
        "mapping": {
            "src_endpoint.ip": "src_ip",
            "src_endpoint.port": "src_port",
            "dst_endpoint.ip": "dest_ip",
            "dst_endpoint.port": "dest_port",
            "connection_info.protocol": "proto",
            "connection_info.session_id": "flow_id",
            "traffic.bytes_in": "flow.bytes_toclient",
            "traffic.bytes_out": "flow.bytes_toserver",
            "disposition.action": ["alert.action", "action"],
            "severity.level": "alert.severity",
            "app_name": "app_proto",
            "threat.signature_id": "alert.signature_id",
            "threat.signature_name": "alert.signature",
            "threat.category": "alert.category",
            "timestamp": "timestamp",
        },
        "value_maps": {
            "disposition.action": {
                "allowed": "Allowed",
                "blocked": "Blocked",
                "dropped": "Dropped",
            }
        },
    },
    {
        "id": "pfsense_filterlog",
        "name": "pfSense / OPNsense Packet Filter Parser",
        "vendor": "pfSense / Netgate",
        "product": "pfSense Packet Filter (pf)",
        "version": "2.7",
        "format": "regex",
        "parser_config": {
            "pattern": r"(?:filterlog(?::|\[\d+\]:)?\s*)?(?P<rule>\d*),(?P<sub_rule>\d*),(?P<anchor>[^,]*),(?P<tracker>\d*),(?P<interface>[^,]+),(?P<reason>[^,]+),(?P<action>pass|block),(?P<direction>in|out),(?P<ip_version>\d),(?P<tos>[^,]*),(?P<ecn>[^,]*),(?P<ttl>\d*),(?P<id>\d*),(?P<offset>\d*),(?P<ip_flags>[^,]*),(?P<proto_id>\d+),(?P<proto_name>[^,]+),(?P<length>\d+),(?P<src_ip>[^,]+),(?P<dst_ip>[^,]+),(?P<src_port>\d+),(?P<dst_port>\d+)"
        },
        "mapping": {
            "src_endpoint.ip": "src_ip",
            "src_endpoint.port": "src_port",
            "src_endpoint.interface": "interface",
            "dst_endpoint.ip": "dst_ip",
            "dst_endpoint.port": "dst_port",
            "connection_info.protocol": "proto_name",
            "traffic.total_bytes": "length",
            "disposition.action": "action",
        },
        "value_maps": {"disposition.action": {"pass": "Allowed", "block": "Blocked"}},
    },
    {
        "id": "zeek_conn",
        "name": "Zeek / Bro Network Monitor Connection Parser",
        "vendor": "Zeek",
        "product": "Zeek Network Security Monitor",
        "version": "6.0",
        "format": "regex",
        "parser_config": {
            "pattern": r"^(?P<ts>[\d\.]+)\t(?P<uid>\w+)\t(?P<src_ip>[\d\.]+)\t(?P<src_port>\d+)\t(?P<dst_ip>[\d\.]+)\t(?P<dst_port>\d+)\t(?P<proto>\w+)\t(?P<service>[^\t]+)\t(?P<duration>[^\t]+)\t(?P<orig_bytes>[^\t]+)\t(?P<resp_bytes>[^\t]+)\t(?P<conn_state>[^\t]+)"
        },
        "mapping": {
            "src_endpoint.ip": "src_ip",
            "src_endpoint.port": "src_port",
            "dst_endpoint.ip": "dst_ip",
            "dst_endpoint.port": "dst_port",
            "connection_info.protocol": "proto",
            "connection_info.session_id": "uid",
            "traffic.bytes_in": "resp_bytes",
            "traffic.bytes_out": "orig_bytes",
            "traffic.duration_ms": "duration",
            "disposition.action": "conn_state",
            "app_name": "service",
            "timestamp": "ts",
        },
        # Upper-case keys never meet the lower-cased verb, so states stay Unknown.
        "value_maps": {
            "disposition.action": {
                "SF": "Allowed",
                "S0": "Blocked",
                "REJ": "Blocked",
                "RSTO": "Reset",
                "RSTR": "Reset",
            }
        },
    },
    {
        "id": "generic_cef",
        "name": "Common Event Format (CEF) Standard Parser",
        "vendor": "Standard CEF",
        "product": "Perimeter Security Appliance",
        "version": "CEF-0.1",
        "format": "cef",
        "mapping": {
            "src_endpoint.ip": "src",
            "src_endpoint.port": "spt",
            "dst_endpoint.ip": "dst",
            "dst_endpoint.port": "dpt",
            "connection_info.protocol": "proto",
            "traffic.bytes_in": ["in", "bytesIn", "rcvdbyte"],
            "traffic.bytes_out": ["out", "bytesOut", "sentbyte"],
            "disposition.action": "act",
            "severity.level": "severity",
            "app_name": ["app", "cs1"],
            "threat.signature_id": "device_event_class_id",
            "threat.signature_name": "event_name",
        },
        "value_maps": {
            "disposition.action": {
                "permit": "Allowed",
                "allow": "Allowed",
                "block": "Blocked",
                "deny": "Blocked",
                "drop": "Dropped",
            }
        },
    },
    {
        "id": "generic_leef",
        "name": "Log Event Extended Format (LEEF) Parser",
        "vendor": "Standard LEEF",
        "product": "Perimeter Security Gateway",
        "version": "LEEF-2.0",
        "format": "leef",
        "mapping": {
            "src_endpoint.ip": ["src", "srcAddress"],
            "src_endpoint.port": ["srcPort", "spt"],
            "dst_endpoint.ip": ["dst", "dstAddress"],
            "dst_endpoint.port": ["dstPort", "dpt"],
            "connection_info.protocol": ["proto", "protocol"],
            "traffic.total_bytes": ["totalBytes", "bytes"],
            "disposition.action": "action",
            "severity.level": "sev",
            "threat.signature_id": "event_id",
        },
        "value_maps": {
            "disposition.action": {
                "permit": "Allowed",
                "allow": "Allowed",
                "block": "Blocked",
                "deny": "Blocked",
            }
        },
    },
    {
        "id": "generic_kv",
        "name": "Generic Key-Value Perimeter Log Parser",
        "vendor": "Generic",
        "product": "Network Device",
        "version": "1.0",
        "format": "key_value",
        "mapping": {
            "src_endpoint.ip": ["src_ip", "srcip", "src", "source_ip", "saddr"],
            "src_endpoint.port": ["src_port", "srcport", "spt", "source_port"],
            "dst_endpoint.ip": ["dst_ip", "dstip", "dst", "destination_ip", "daddr"],
            "dst_endpoint.port": ["dst_port", "dstport", "dpt", "destination_port"],
            "connection_info.protocol": ["proto", "protocol", "proto_name"],
            "traffic.bytes_in": ["bytes_in", "bytes_received", "rcvdbyte", "in"],
            "traffic.bytes_out": ["bytes_out", "bytes_sent", "sentbyte", "out"],
            "traffic.total_bytes": ["bytes", "total_bytes"],
            "disposition.action": ["action", "act", "status"],
            "severity.level": ["severity", "level", "priority"],
            "app_name": ["app", "application", "service"],
        },
    },
    {
        "id": "generic_syslog",
        "name": "Generic RFC 3164 / 5424 Syslog Parser",
        "vendor": "Generic",
        "product": "Syslog Perimeter Relay",
        "version": "1.0",
        "format": "syslog",
        "mapping": {
            "severity.level": "_syslog_meta.syslog_severity",
            "disposition.action": "action",
        },
    },
]

# What a line gets whose parser id has no spec.
FALLBACK = {
    "name": "Generic Fallback Parser",
    "vendor": "Generic",
    "product": "Perimeter Device",
    "version": "1.0.0",
    "format": "key_value",
}

# Source keys tried for a canonical field that a spec does not map.
DEFAULT_KEYS = {
    "src_endpoint.ip": ["src_ip", "srcip", "src", "source_ip", "suser"],
    "src_endpoint.port": ["src_port", "srcport", "spt", "source_port"],
    "src_endpoint.zone": ["src_zone", "from_zone", "srcintf"],
    "dst_endpoint.ip": ["dst_ip", "dstip", "dst", "destination_ip"],
    "dst_endpoint.port": ["dst_port", "dstport", "dpt", "destination_port"],
    "dst_endpoint.zone": ["dst_zone", "to_zone", "dstintf"],
    "connection_info.protocol": ["proto", "protocol", "proto_name"],
    "connection_info.session_id": ["sessionid", "session_id", "conn_id"],
    "traffic.bytes_in": ["bytes_in", "bytes_received", "rcvdbyte", "rcvdbytes"],
    "traffic.bytes_out": ["bytes_out", "bytes_sent", "sentbyte", "sentbytes"],
    "traffic.total_bytes": ["bytes", "total_bytes", "byte_count"],
    "traffic.packets_in": ["packets_in", "pkts_received", "rcvdpkt"],
    "traffic.packets_out": ["packets_out", "pkts_sent", "sentpkt"],
    "traffic.duration_ms": ["duration_ms", "elapsed", "duration"],
    "disposition.action": ["action", "act", "status", "disposition"],
    "severity.level": ["severity", "level", "priority"],
    "app_name": ["app", "application", "service", "proto_name"],
    "threat.signature_id": ["signature_id", "threat_id", "rule_id"],
    "threat.signature_name": ["signature", "threat_name", "alert_signature"],
    "threat.category": ["category", "threat_category", "classification"],
    "timestamp": ["timestamp", "time", "date_time", "datetime", "generated_time"],
}
