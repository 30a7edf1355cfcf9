"""Rule sets of the classification vocabulary. Each stage has its own; they are parameters, never merged."""

#: Dump extraction drops these (lower case).
DUMP_EXCLUDE = ("indifferent", "unknown")
#: Conversion rejects these without a lookup (trimmed, lower case).
CONVERT_SKIP = ("indifferent", "unknown", "whitelist")
#: Conversion accepts these (trimmed, lower case).
CONVERT_VALID = ("ransomware", "maltool", "hacktool", "unwanted", "malware", "suspicious", "blacklist", "av_detected")
#: The keep-set filter (case-sensitive).
KEEP_SET = ("malware", "ransomware", "unwanted", "hacktool")
#: The target's enum, upper case; PUA counts as UNWANTED, everything else as UNKNOWN.
TARGET_ENUM = ("RANSOMWARE", "MALTOOL", "HACKTOOL", "UNWANTED", "MALWARE", "SUSPICIOUS", "BLACKLIST", "AV_DETECTED", "INDIFFERENT", "UNKNOWN")
TARGET_ALIASES = {"PUA": "UNWANTED"}
TARGET_DEFAULT = "UNKNOWN"
#: Domain classifications.
DOMAIN_ENUM = ("malware", "ransomware", "maltool", "hacktool", "unwanted", "suspicious", "blacklist", "av_detected", "whitelist", "indifferent", "sinkholed", "unresolved")
DOMAIN_DEFAULT = "MALWARE"
#: Types from the highest priority to the lowest; a table parameter wherever it is used.
PRIORITY = ("ransomware", "maltool", "hacktool", "unwanted", "malware", "sinkholed", "suspicious", "whitelist", "indifferent", "unresolved", "unknown", "no_type_found", "blacklist", "av_detected")
#: Subtypes.
SUBTYPES = ("trojan", "ransom", "backdoor", "downloader", "dropper", "worm", "virus", "rootkit", "exploit", "miner", "adware", "spyware", "riskware", "greyware", "unrecognized")
SOURCE = "VIRUS_TOTAL"
MOST_DOMAIN_CHARS = 253
DAY_MS = 86_400_000
#: Lifetimes in milliseconds.
TTL_DEFAULT, TTL_MOST, TTL_RECHECK, TTL_UNKNOWN = 30 * DAY_MS, 30 * DAY_MS, 7 * DAY_MS, DAY_MS
