"""Declared log columns.  Dots in raw names become underscores at ingest."""

from __future__ import annotations

# --- Fixed values: raw column names and types of the seven logs --------------
# types: time, interval, count, port, bool, string
_ENDS = "id.orig_h:string id.orig_p:port id.resp_h:string id.resp_p:port"
_HEAD = f"ts:time uid:string {_ENDS}"
LOGS = {
    "conn": f"{_HEAD} proto:string service:string duration:interval orig_bytes:count resp_bytes:count "
            "conn_state:string local_orig:bool local_resp:bool missed_bytes:count history:string orig_pkts:count "
            "orig_ip_bytes:count resp_pkts:count resp_ip_bytes:count",
    "dns": f"{_HEAD} proto:string trans_id:count rtt:interval query:string qclass:count qclass_name:string "
           "qtype:count qtype_name:string rcode:count rcode_name:string AA:bool TC:bool RD:bool RA:bool Z:count "
           "rejected:bool",
    "http": f"{_HEAD} trans_depth:count method:string host:string uri:string referrer:string version:string "
            "user_agent:string origin:string request_body_len:count response_body_len:count status_code:count "
            "status_msg:string",
    "ssl": f"{_HEAD} version:string cipher:string curve:string server_name:string resumed:bool established:bool "
           "subject:string issuer:string not_valid_before:time not_valid_after:time ja3:string ja3s:string",
    "notice": f"{_HEAD} note:string msg:string sub:string src:string dst:string p:port actions:string "
              "suppress_for:interval identifier:string",
    "files": "ts:time fuid:string uid:string id.orig_h:string id.resp_h:string source:string depth:count "
             "analyzers:string mime_type:string filename:string duration:interval seen_bytes:count total_bytes:count "
             "missing_bytes:count overflow_bytes:count timedout:bool md5:string sha1:string sha256:string",
    "weird": f"{_HEAD} name:string addl:string notice:bool peer:string",
}


def columns(kind: str) -> dict[str, str]:
    """Raw column name -> log type; empty for an unknown kind."""
    return dict(c.rsplit(":", 1) for c in LOGS.get(kind, "").split())


EVENT_TYPES = ["alert", "dns", "http", "tls", "flow", "fileinfo", "stats"]

EVENTS = (
    "timestamp string, flow_id long, in_iface string, event_type string, src_ip string, src_port string, "
    "dest_ip string, dest_port string, proto string, "
    "alert struct<action:string,gid:string,signature_id:string,rev:string,signature:string,category:string,severity:string>, "
    "http struct<hostname:string,url:string,http_user_agent:string,http_method:string,protocol:string,status:string,length:string>, "
    "dns struct<type:string,id:string,rrname:string,rrtype:string,tx_id:string>, "
    "tls struct<subject:string,issuerdn:string,serial:string,fingerprint:string,ja3:struct<hash:string,string:string>,"
    "notbefore:string,notafter:string>, "
    "smb struct<id:string,dialect:string,command:string,status:string,filename:string,share:string>, "
    "flow struct<pkts_toserver:string,pkts_toclient:string,bytes_toserver:string,bytes_toclient:string,start:string>")

# numeric fields of alert events, read as text and cast so that a bad value becomes null
EVENT_NUMBERS = {
    "src_port": "int", "dest_port": "int", "alert.severity": "long", "alert.gid": "long", "alert.rev": "long",
    "alert.signature_id": "long", "http.status": "long", "http.length": "long", "flow.pkts_toserver": "long",
    "flow.pkts_toclient": "long", "flow.bytes_toserver": "long", "flow.bytes_toclient": "long", "dns.id": "long",
}
