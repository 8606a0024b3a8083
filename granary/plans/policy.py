"""Policy tables: taxonomy, categories, tools and profiles that the rules and planners refer to."""

from __future__ import annotations

#: Domain: prefix of its ids, and how many there are.
DOMAINS = {"anti_forensics": ("AF", 4), "ai_llm": ("A", 4), "cloud": ("C", 6), "compliance": ("CL", 2), "file_storage": ("F", 5), "iot_ot": ("OT", 2), "linux": ("L", 8), "mobile": ("M", 3), "network": ("N", 6), "siem": ("S", 3), "supply_chain": ("SC", 1), "threat_intel": ("TI", 2), "virtualization": ("V", 1), "windows": ("W", 10)}
TAXONOMY = {d: [f"{p}{k}" for k in range(1, n + 1)] for d, (p, n) in DOMAINS.items()}
ALL_REFS = sorted(x for ids in TAXONOMY.values() for x in ids)
SIGNALS = {
    "report_generation": "uncertainty summary report overclaim limitation impact finding evidence confidence caveat".split(),
    "detection_engineering": [*"tuning translate telemetry sigma rule query logic detection coverage".split(), "false positive"],
    "triage_and_hunting": "triage scope review prioritize pivot investigate hunt evidence corroborate collect".split(),
    "ttp_identification": "technique tactic mitre mapping confidence chain candidate behavior atlas attack".split(),
    "artifact_analysis": "value timeline path parse log file field evidence artifact anomaly".split(),
}
CATEGORY_TARGETS = {"artifact_analysis": 0.30, "detection_engineering": 0.14, "report_generation": 0.13, "triage_and_hunting": 0.18, "ttp_identification": 0.25}
DIFFICULTY_TARGETS = {"junior": 0.3, "mid": 0.5, "senior": 0.2}
TOOLS = sorted({t.lower() for t in "zip yara wmic wireshark wget wevtutil volatility3 vol.py velociraptor tcpdump tar sysmon sysinternals suricata strings stat snort sigma schtasks sc rundll32 rubeus rsync regsvr32 reg recmd readelf pwsh psexec procdump powerview powersploit powershell osascript openssl objdump nmap netsh netcat net mimikatz logparser lazagne kape journalctl impacket hayabusa finder find empire dsinternals dd cyberchef curl cowrie cmd certutil cat bstrings bloodhound bash auditd aadinternals 7z 7-zip mftecmd".split()} | {"volatility 3", "gcloud cli", "event viewer", "dfir orc", "cobalt strike", "carbon black"})
ATTACK_IDS = [f"T{n}" for n in (1003, 1021, 1053, 1055, 1059, 1071, 1105, 1547)] + ["T1003.001", "T1059.001", "T1547.001"]
ATLAS_IDS = [f"AML.T00{n}" for n in (16, 24, 40, 43, 51)]
POLICY = {"signals": SIGNALS, "taxonomy": ALL_REFS, "attack_ids": ATTACK_IDS, "atlas_ids": ATLAS_IDS, "tools": TOOLS}
