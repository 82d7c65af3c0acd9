"""Mapping of raw logs to the common event schema, one projection per log kind.

Nested output structs follow the dotted field names; a missing source column gives a null
field.  Rows whose timestamp cannot be read are not dropped: ``failures`` returns them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netsift.functions import text
from netsift.operators.enrich import locate

# --- Fixed values: field names, raw column -> common field -------------------
ENDPOINTS = {"id_orig_h": "source.ip", "id_orig_p": "source.port", "id_resp_h": "destination.ip",
             "id_resp_p": "destination.port"}
CONN = {**ENDPOINTS, "proto": "network.transport", "service": "network.protocol", "duration": "event.duration",
        "orig_bytes": "source.bytes", "resp_bytes": "destination.bytes", "orig_pkts": "source.packets",
        "resp_pkts": "destination.packets", "conn_state": "zeek.conn.state", "history": "zeek.conn.history",
        "missed_bytes": "zeek.conn.missed_bytes", "local_orig": "zeek.conn.local_orig",
        "local_resp": "zeek.conn.local_resp"}
DNS = {**ENDPOINTS, "proto": "network.transport", "query": "dns.question.name", "qtype_name": "dns.question.type",
       "rcode_name": "dns.response_code", "answers": "dns.answers", "TTLs": "zeek.dns.TTLs", "trans_id": "dns.id",
       "rtt": "zeek.dns.rtt", "AA": "zeek.dns.AA", "TC": "zeek.dns.TC", "RD": "zeek.dns.RD", "RA": "zeek.dns.RA",
       "rejected": "zeek.dns.rejected"}
HTTP = {**ENDPOINTS, "method": "http.request.method", "host": "url.domain", "uri": "url.path",
        "referrer": "http.request.referrer", "user_agent": "user_agent.original",
        "status_code": "http.response.status_code", "request_body_len": "http.request.body.bytes",
        "response_body_len": "http.response.body.bytes", "resp_mime_types": "zeek.http.resp_mime_types",
        "tags": "zeek.http.tags", "username": "user.name", "proxied": "zeek.http.proxied"}
EVE = {"src_ip": "source.ip", "src_port": "source.port", "dest_ip": "destination.ip", "dest_port": "destination.port",
       "proto": "network.transport", "in_iface": "observer.ingress.interface.name", "alert.signature": "rule.name",
       "alert.signature_id": "rule.id", "alert.category": "rule.category", "alert.severity": "event.severity",
       "alert.action": "event.action", "http.hostname": "url.domain", "http.url": "url.path",
       "http.http_user_agent": "user_agent.original", "http.http_method": "http.request.method",
       "http.status": "http.response.status_code", "dns.rrname": "dns.question.name",
       "dns.rrtype": "dns.question.type", "tls.subject": "tls.server.subject", "tls.issuerdn": "tls.server.issuer",
       "tls.ja3.hash": "tls.client.ja3", "flow.bytes_toserver": "source.bytes",
       "flow.bytes_toclient": "destination.bytes", "flow.pkts_toserver": "source.packets",
       "flow.pkts_toclient": "destination.packets"}


def _has(schema: T.StructType, path: str) -> bool:
    node: T.DataType = schema
    for part in path.split("."):
        if not isinstance(node, T.StructType) or part not in node.fieldNames():
            return False
        node = node[part].dataType
    return True


def _nest(fields: dict[str, Column]) -> list[Column]:
    """Dotted names to nested struct columns."""
    tree: dict = {}
    for name, column in fields.items():
        node = tree
        *parents, leaf = name.split(".")
        for p in parents:
            node = node.setdefault(p, {})
        node[leaf] = column

    def build(node: dict) -> list[Column]:
        return [(F.struct(*build(v)) if isinstance(v, dict) else v).alias(k) for k, v in node.items()]

    return build(tree)


def _mapped(df: DataFrame, names: dict[str, str]) -> dict[str, Column]:
    return {target: F.col(source) for source, target in names.items() if _has(df.schema, source)}


def _geo(df: DataFrame, ranges: DataFrame | None, src: str, dst: str) -> tuple[DataFrame, dict[str, Column]]:
    if ranges is None:
        return df, {}
    out = locate(locate(df, ranges, dst, "_dst"), ranges, src, "_src")
    fields = {}
    for side, name in (("_src", "source"), ("_dst", "destination")):
        known = F.col(f"{side}_country").isNotNull()
        location = F.when(known, F.struct(F.col(f"{side}_lat").alias("lat"), F.col(f"{side}_lon").alias("lon")))
        fields[f"{name}.geo.country_name"] = F.col(f"{side}_country")
        fields[f"{name}.geo.location"] = location
    return out, fields


def _common(dataset: str | Column, module: str, kind: str | Column, category: list[str] | Column,
            types: list[str] | None) -> dict[str, Column]:
    lit = lambda v: F.lit(v) if isinstance(v, str) else v
    arr = lambda v: F.array(*[F.lit(x) for x in v]) if isinstance(v, list) else v
    out = {"event.dataset": lit(dataset), "event.module": F.lit(module), "event.kind": lit(kind),
           "event.category": arr(category)}
    if types:
        out["event.type"] = arr(types)
    return out


def conn_to_ecs(conn: DataFrame, ranges: DataFrame | None = None) -> DataFrame:
    conn, geo = _geo(conn, ranges, "id_orig_h", "id_resp_h")
    fields = {"@timestamp": F.col("ts"), **_common("zeek.conn", "zeek", "event", ["network"], ["connection", "info"]),
              **_mapped(conn, CONN), **geo}
    if {"source.bytes", "destination.bytes"} <= fields.keys():
        fields["network.bytes"] = fields["source.bytes"] + fields["destination.bytes"]
    return conn.select(*_nest(fields))


def dns_to_ecs(dns: DataFrame, ranges: DataFrame | None = None) -> DataFrame:
    dns, geo = _geo(dns, ranges, "id_orig_h", "id_resp_h")
    fields = {"@timestamp": F.col("ts"), **_common("zeek.dns", "zeek", "event", ["network"], ["protocol", "info"]),
              **_mapped(dns, DNS), **geo,
              "dns.question.registered_domain": text.base_domain("query", single_is_null=True),
              "zeek.dns.first_label_length": F.length(text.first_label("query"))}
    return dns.select(*_nest(fields))


def http_to_ecs(http: DataFrame, ranges: DataFrame | None = None) -> DataFrame:
    """The request target is split into path, query, extension and fragment; ``url.full`` keeps the split path."""
    http, geo = _geo(http, ranges, "id_orig_h", "id_resp_h")
    fields = {"@timestamp": F.col("ts"), **_common("zeek.http", "zeek", "event", ["network", "web"], ["access"]),
              **_mapped(http, HTTP), **geo}
    fields.update({f"url.{part}": c for part, c in text.uri_parts("uri").items()})
    fields["url.original"] = F.col("uri")
    fields["url.full"] = text.full_url(F.col("host"), fields["url.path"])
    code = F.col("status_code")
    fields["event.outcome"] = F.when(code < 400, "success").when(code >= 400, "failure")
    return http.select(*_nest(fields))


def eve_to_ecs(events: DataFrame, ranges: DataFrame | None = None, ts: str = "timestamp") -> DataFrame:
    """Events to the common schema; undeclared fields (``extra`` of the reader) go along as the VARIANT ``suricata.eve``."""
    events, geo = _geo(events, ranges, "src_ip", "dest_ip")
    is_alert = F.col("event_type") == "alert"
    category = F.when(is_alert, F.array(F.lit("network"), F.lit("intrusion_detection"))).otherwise(
        F.array(F.lit("network")))
    fields = {"@timestamp": F.col(ts).try_cast("timestamp"),
              **_common(F.concat(F.lit("suricata."), "event_type"), "suricata",
                        F.when(is_alert, "alert").otherwise("event"), category, None),
              **_mapped(events, EVE), **geo}
    if "extra" in events.columns:
        fields["suricata.eve"] = F.col("extra")
    return events.select(*_nest(fields))


def failures(raw: DataFrame, ts: str, dataset: str) -> DataFrame:
    """Rows whose time field is missing or unreadable, with the error and the dataset they belong to."""
    as_time = F.coalesce(F.col(ts).try_cast("timestamp"), F.timestamp_micros(
        (F.col(ts).try_cast("double") * 1_000_000).cast("long"))) if dict(raw.dtypes)[ts] == "string" else F.col(ts)
    text_value = F.coalesce(F.col(ts).cast("string"), F.lit("null"))
    return raw.where(as_time.isNull()).withColumn(
        "error_message", F.concat(F.lit("unable to parse time "), text_value)).withColumn("dataset", F.lit(dataset))


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs to flat columns with joined names."""

    def leaves(schema: T.StructType, path: list[str]) -> list[Column]:
        out = []
        for f in schema.fields:
            here = [*path, f.name]
            if isinstance(f.dataType, T.StructType):
                out += leaves(f.dataType, here)
            else:
                out.append(F.col(".".join(f"`{p}`" for p in here)).alias(sep.join(here)))
        return out

    return df.select(*leaves(df.schema, []))
