"""Class taxonomy, label rules and default settings."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Taxonomy:
    """A closed set of classes: one benign name and the attack names, in report order."""

    benign: str
    attacks: tuple[str, ...]

    @property
    def classes(self) -> list[str]:
        return [self.benign, *self.attacks]


# Class names of the traffic taxonomy.
TRAFFIC = Taxonomy(
    "Benign",
    ("DDoS-HTTP_Flood", "DoS-HTTP_Flood", "DNS_Spoofing", "XSS", "Brute_Force"),
)

# Label rules in order of precedence. A class is chosen when every word of
# one of its word groups occurs in the lower-case text.
CLASS_RULES = (
    ("Benign", (("benign",), ("normal",))),
    ("DDoS-HTTP_Flood", (("ddos", "http"),)),
    ("DoS-HTTP_Flood", (("dos", "http"),)),
    ("DNS_Spoofing", (("dns", "spoof"),)),
    ("XSS", (("xss",),)),
    ("Brute_Force", (("brute",),)),
)

# Words that must not be the tail of a longer word ("abnormal" is not "normal").
WHOLE_START_WORDS = ("normal",)

# Accepted spellings of the identifier columns, after lower-casing and
# removing blanks, underscores and hyphens.
ID_ALIASES = {
    "flow_id": ("flowid",),
    "src_ip": ("srcip", "sourceip", "ipsrc", "saddr", "sourceaddress"),
    "dst_ip": ("dstip", "destip", "destinationip", "ipdst", "daddr", "destinationaddress"),
    "src_port": ("srcport", "sourceport", "sport"),
    "dst_port": ("dstport", "destport", "destinationport", "dport"),
}

# Spellings of a label column, normalised the same way.
LABEL_ALIASES = ("label", "attack", "class", "category", "type")

ENDPOINT_COLUMNS = ("src_ip", "dst_ip", "src_port", "dst_port")
ID_COLUMNS = ("flow_id", "src_ip", "dst_ip", "timestamp", "segment_index")
LABEL_COLUMNS = ("Label", "attack_type")

# Default settings of sampling, detection and the cascade.
N_BENIGN = 200_000
ATTACK_MIN = 4_000
ATTACK_MAX = 6_200
SEED = 42
TARGET_FPR = 0.05
TARGET_CASCADE_RECALL = 0.95
TEST_FRACTION = 0.30
ALERT_BUDGET = 0.20
CLIP_QUANTILES = (0.01, 0.99)
CONTAMINATION_BOUNDS = (0.005, 0.1)
AUTOENCODER_LAYERS = (32, 12, 32)
AUTOENCODER_EPOCHS = 60
KMEANS_K = 8
KMEANS_RESTARTS = 10
FOREST_TREES = 200

# Sample sizes of the scale presets (benign rows, attack rows from-to).
PRESETS = {
    "smoke": {"n_benign": 4_000, "attack_min": 90, "attack_max": 130},
    "demo": {"n_benign": 40_000, "attack_min": 820, "attack_max": 1_240},
    "full": {"n_benign": 200_000, "attack_min": 4_000, "attack_max": 6_200},
}
