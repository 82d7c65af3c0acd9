"""Fixed values shared by the operators."""

# --- Fixed values: English letter shares -------------------------------------
ENGLISH_LETTERS = {
    "a": 0.0817, "b": 0.0149, "c": 0.0278, "d": 0.0425, "e": 0.1270, "f": 0.0223, "g": 0.0202,
    "h": 0.0609, "i": 0.0697, "j": 0.0015, "k": 0.0077, "l": 0.0403, "m": 0.0241, "n": 0.0675,
    "o": 0.0751, "p": 0.0193, "q": 0.0010, "r": 0.0599, "s": 0.0633, "t": 0.0906, "u": 0.0276,
    "v": 0.0098, "w": 0.0236, "x": 0.0015, "y": 0.0197, "z": 0.0007,
}

# --- Fixed values: English bigram shares -------------------------------------
ENGLISH_BIGRAMS = {
    "th": 0.0356, "he": 0.0307, "in": 0.0243, "er": 0.0205, "an": 0.0199, "re": 0.0185, "on": 0.0176,
    "en": 0.0175, "at": 0.0149, "es": 0.0145, "ed": 0.0141, "nd": 0.0135, "to": 0.0134, "or": 0.0128,
    "ea": 0.0127, "ti": 0.0126, "hi": 0.0123, "as": 0.0120, "te": 0.0120, "et": 0.0105,
}

# --- Fixed values: top-level domain risk classes -----------------------------
TLD_HIGH = ["xyz", "top", "tk", "pw", "cc", "biz", "info", "club"]
TLD_MEDIUM = ["net", "org", "co", "io", "me"]
TLD_LOW = ["com", "gov", "edu", "mil"]

# --- Fixed values: local address prefixes (text form) ------------------------
LOCAL_PREFIXES = ["10.", "172.16.", "192.168."]

# --- Fixed values: geohash base-32 alphabet ----------------------------------
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"

# --- Fixed values: alert weights and technique ids ---------------------------
SEVERITY_WEIGHTS = {1: 40, 2: 20, 3: 10}
SEVERITY_LABELS = {1: "HIGH", 2: "MEDIUM", 3: "LOW"}
NOTICE_WEIGHTS = {
    "C2_Beaconing_Detected": 50,
    "C2_SSL_SelfSigned": 30,
    "C2_JA3_Suspicious": 45,
    "DNS_High_NXDOMAIN_Ratio": 25,
    "Exfil_High_Volume_Outbound": 40,
    "Exfil_DNS_Tunneling": 35,
    "LM_SMB_Multi_Host_Scan": 30,
    "LM_PsExec_Detected": 45,
    "LM_Auth_Spray": 35,
    "SMB_PsExec_Pattern": 50,
}
DEFAULT_NOTICE_WEIGHT = 15
DEFAULT_SEVERITY_WEIGHT = 10
TECHNIQUES = {
    "C2_Beaconing_Detected": "T1071.001",
    "C2_SSL_SelfSigned": "T1573.002",
    "C2_JA3_Suspicious": "T1071.001",
    "DNS_High_NXDOMAIN_Ratio": "T1071.004",
    "Exfil_High_Volume_Outbound": "T1048.003",
    "Exfil_DNS_Tunneling": "T1048",
    "LM_SMB_Multi_Host_Scan": "T1021.002",
    "LM_PsExec_Detected": "T1569.002",
    "LM_Auth_Spray": "T1110.003",
    "SMB_PsExec_Pattern": "T1569.002",
}

# --- Fixed values: TLS and HTTP indicators -----------------------------------
MALICIOUS_JA3 = [
    "a0e9f5d64349fb13191bc781f81f42e1",
    "72a589da586844d7f0818ce684948eea",
    "de9f2c7fd25e1b3afad3e85a0bd17d9b",
    "4d7a28d6f2263ed61de88ca66eb011e3",
    "b386946a5a44d1ddcc843bc75336dfce",
    "d0ec3b5f84b63bb40fa5e8e2b3e9e7f5",
]
HUNT_JA3 = MALICIOUS_JA3[:3]
MALWARE_CERT_NAMES = ["AsyncRAT Server", "Metasploit", "localhost", "test"]
SUSPICIOUS_TLS_PORTS = [4443, 8443, 6606, 7707, 9001, 1337]
SUSPICIOUS_AGENTS = [
    r"python-requests",
    r"Go-http-client",
    r"curl/",
    r"Wget/",
    r"libwww-perl",
    r"Mozilla/4\.0 \(compatible\)$",
]
TRUSTED_ISSUERS = ["Let's Encrypt", "DigiCert", "GlobalSign"]

# --- Fixed values: file-share indicators -------------------------------------
SUSPICIOUS_EXTENSIONS = ["exe", "dll", "ps1", "bat", "vbs", "scr", "hta", "pif", "com", "lnk", "jar", "wsf"]
RANSOMWARE_EXTENSIONS = [
    "locky", "zepto", "cerber", "crypt", "encrypted", "locked", "wncry", "wnry", "wcry", "onion"]

# --- Fixed values: published indicators (type, value, family, role, confidence) ---
INDICATORS = [
    ("ip", "45.33.32.156", "Emotet Epoch 4", "C2 primary", "HIGH"),
    ("ip", "185.220.101.10", "TrickBot", "C2", "HIGH"),
    ("ip", "103.75.190.11", "Emotet/TrickBot", "Payload delivery", "HIGH"),
    ("ip", "185.220.101.45", "Cobalt Strike", "Team Server", "VERY HIGH"),
    ("ip", "91.92.241.103", "AsyncRAT", "C2", "VERY HIGH"),
    ("ip", "185.180.143.44", "DNS Tunneling", "Attacker NS", "HIGH"),
    ("domain", "jquery-cdn.net", "Cobalt Strike", "Fake CDN typosquatting", None),
    ("domain", "exfil.c2ops.net", "DNS Tunneling", "Data receiver", None),
    ("domain", "c2ops.net", "DNS Tunneling", "Attacker TLD", None),
    ("hash", "d41d8cd98f00b204e9800998ecf8427e", "TrickBot dropper", "MD5", None),
    ("hash", "da39a3ee5e6b4b0d3255bfef95601890afd80709", "TrickBot dropper", "SHA1", None),
    ("hash", "5f4dcc3b5aa765d61d8327deb882cf99", "Cobalt Strike", "MD5", None),
    ("hash", "aefb9ef5b7a4d55b67d6f1b5fe6e4f91", "AsyncRAT", "MD5", None),
    ("ja3", "a0e9f5d64349fb13191bc781f81f42e1", "Cobalt Strike", "default profile", "VERY HIGH"),
    ("ja3", "72a589da586844d7f0818ce684948eea", "Metasploit Meterpreter", None, "HIGH"),
    ("ja3", "de9f2c7fd25e1b3afad3e85a0bd17d9b", "AsyncRAT", None, "VERY HIGH"),
    ("cert", "CN=AsyncRAT Server", "AsyncRAT", "Self-signed, hardcoded CN", None),
    ("cert", "CN=jquery-cdn.net", "Cobalt Strike", "Self-signed fake CDN cert", None),
    ("cert", "CN=lab.example.com", "Emotet loader", "Self-signed generic", None),
    ("url", "http://45.33.32.156/bqkV2/Kx9m/", "Emotet", "POST", None),
    ("url", "http://185.220.101.10/images/abcd1234efgh/", "TrickBot", "POST", None),
    ("url", "http://103.75.190.11/update.exe", "TrickBot dropper", "GET", None),
    ("url", "https://185.220.101.45/jquery-3.3.1.min.js", "Cobalt Strike", "GET/POST", None),
]
