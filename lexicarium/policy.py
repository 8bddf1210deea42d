"""Thresholds, rules and allowed values of the decisions over units and values: data that operators compile to columns."""

from __future__ import annotations

#: Noise rules.
NOISE = {
    "min_length": 2,
    "punctuation": ".,;:!?，。；：？！",
    "symbols": "-_=+*/\\|<>~`^#@",
    "patterns": (("^[-_]{2,}$", "repeated_symbols"), (r"^\*{2,}$", "repeated_symbols"), (r"^\d+$", "numeric_only")),
}
#: Structure profile.
STRUCTURE = {"dominant": 0.8, "early": 0.33, "late": 0.67, "stable_paths": 3, "stable_segments": 5, "incidental_segments": 2}
#: Boundary thresholds, (OK up to, UNSTABLE up to).
BOUNDARY = {"min_occurrences": 3, "length_variance": (1.5, 3.5), "segment_crossing": (0.2, 0.5), "sentence_crossing": (0.3, 0.6)}
#: Decisions of the prominence policy.
PROMINENCE = {"boundary": "DELAY", "noise": {"high": "FREEZE", "medium": "DELAY", "low": "ALLOW"}, "role": {"stable": "ALLOW", "diffuse": "DELAY", "incidental": "FREEZE"}}
#: Attributes of a concept and their allowed values (None: any).
ATTRIBUTES = {
    "occurrence_count": None,
    "path_diversity": None,
    "dominant_path_ratio": None,
    "decision": ("ALLOW", "DELAY", "FREEZE"),
    "boundary_status": ("OK", "UNSTABLE", "ANOMALOUS", "SKIP"),
    "noise_risk": ("low", "medium", "high"),
    "structural_role": ("stable", "diffuse", "incidental"),
    "audit_confidence": None,
}
#: The parse-eligibility policy. A rule's conditions name observations; ``${thresholds.x.y}`` stands for a threshold.
ELIGIBILITY = {
    "default": "ALLOW",
    "on_missing": "DELAY",
    "thresholds": {
        "entropy_by_block": {"block_entropy_max": 1.5, "block_dominance_min": 0.5},
        "entropy": {"avg_max_combined": 5.5},
        "unicode": {"control_ratio_max": 0.01, "control_ratio_freeze": 0.05},
        "block_transitions": {"density_max_combined": 0.4},
        "line_structure": {"indented_line_ratio_min": 0.3, "paired_symbol_line_ratio_min": 0.3},
    },
    "rules": (
        {"id": "allow_structured_content", "match": "all", "override": True, "decision": "ALLOW", "when": {"line_structure.indented_line_ratio": {"ge": "${thresholds.line_structure.indented_line_ratio_min}"}, "line_structure.paired_symbol_line_ratio": {"ge": "${thresholds.line_structure.paired_symbol_line_ratio_min}"}}},
        {"id": "freeze_repetitive_dominant_block", "decision": "FREEZE", "composite": "dominant_block_low_entropy", "params": {"entropy": "${thresholds.entropy_by_block.block_entropy_max}", "share": "${thresholds.entropy_by_block.block_dominance_min}"}},
        {"id": "freeze_extreme_control_chars", "match": "any", "decision": "FREEZE", "when": {"unicode.control_ratio_strict": {"gt": "${thresholds.unicode.control_ratio_freeze}"}}},
        {"id": "delay_control_char_ratio", "match": "any", "decision": "DELAY", "when": {"unicode.control_ratio_strict": {"gt": "${thresholds.unicode.control_ratio_max}"}}},
        {"id": "delay_encoding_damage", "match": "all", "decision": "DELAY", "when": {"entropy.avg": {"gt": "${thresholds.entropy.avg_max_combined}"}, "block_transitions.transition_density": {"gt": "${thresholds.block_transitions.density_max_combined}"}}},
    ),
}


def resolved(value, thresholds: dict):
    """value with every ``${thresholds.a.b}`` replaced by the threshold it names."""
    if isinstance(value, dict):
        return {k: resolved(v, thresholds) for k, v in value.items()}
    if isinstance(value, str) and value.startswith("${thresholds."):
        found = thresholds
        for part in value[len("${thresholds.") : -1].split("."):
            found = found[part]
        return found
    return value
