"""Thresholds of the resolution rules. Every operator takes them as parameters; these are the defaults."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    # fixed values: gates and windows of the reference's rules
    hint_window_s: float = 2.0
    delayed_window_s: float = 20.0
    min_ocr_conf: float = 0.60
    min_ocr_len: int = 3
    min_face_quality: float = 0.70
    telemetry_face_quality: float = 0.80
    blur_variance: float = 70.0
    person_conf: float = 0.80
    anchor_ratio: float = 0.22
    rescue_factor: float = 0.25
    top_n: int = 6
    border_px: int = 5
    nms_iou: float = 0.60
    nms_containment: float = 0.65
    merge_face: float = 0.40
    merge_reid: float = 0.70
    veto_face: float = 0.30
    veto_reid: float = 0.65
    gate_face: float = 0.75
    gate_reid: float = 0.85
    gate_reid_strong: float = 0.88
    gate_face_floor: float = 0.60
    enroll_sim: float = 0.40
    ema: float = 0.8
    shard_dist: float = 0.20
    shard_min_count: int = 3
    max_shards: int = 4
    gallery_k: int = 5
    tiebreak_face: float = 0.4
    tiebreak_reid: float = 0.6
    tiebreak_gap: float = 0.05
    misread_conf: float = 0.85
    calibration_least: int = 3
    batch_images: int = 128


SETTINGS = Settings()

# fixed values: trust ranks of match types, the smaller the more trusted, for enrollment and for the order of intents
ENROLL_RANK = {
    "golden_sample": 0, "golden_partial": 1, "golden_delayed": 2, "error_map_timing": 3, "ocr_unvalidated": 4,
    "ocr_registered": 4, "blind_trust": 5, "hint_remainder": 6, "ghost_adopted": 7, "ghost": 8,
}
INTENT_PRIORITY = ENROLL_RANK | {
    "ghost_multi_bib": 9, "ghost_ambiguous_partial": 9, "course_ocr_validated": 10, "course_biometric_match": 11,
    "course_ocr_ambiguous": 12, "course_bib_conflict": 13, "course_ghost": 14,
}
DEFAULT_RANK = 8
# fixed values: readings that are often misread, with what they may be
OCR_ERRORS = {"39": ["394", "139"], "12": ["72", "02"], "185": ["785", "1B5"]}
