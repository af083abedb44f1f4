"""Message and table schemas as Spark DDL."""

from __future__ import annotations

BIB = "struct<bib_number: string, ocr_confidence: double>"
PERSON = f"struct<bbox: array<double>, confidence: double, blur_score: double, is_blurry: boolean, face_quality: double, face_yaw: double, face_vec: array<float>, reid_vec: array<float>, bib_number: string, ocr_confidence: double, bibs: array<{BIB}>>"
IMAGE = f"struct<photo_id: string, path: string, burst_seq: int, corrected_time: string, hints: array<string>, img_width: int, img_height: int, inference_ms: double, success: boolean, error: string, persons: array<{PERSON}>>"
#: One burst out of the inference tier.
RAW_INFERENCE = f"task_type string, schema_version int, project_id string, job_id string, burst_id string, photo_ids array<long>, priority int, camera_id string, camera_serial string, inference_profile string, submitted_at double, processed_at double, inference_ms double, images array<{IMAGE}>"
#: A batch of photos to fetch.
FETCH_TASK = "task_type string, burst_id string, sub_event_id string, project_id string, priority int, images array<struct<photo_id: string, path: string>>, payload struct<photos: array<struct<photo_id: string, path: string>>>"
#: A calibration request and its result.
CALIBRATION_TASK = "task_type string, project_id string, payload struct<photos: array<struct<path: string, photo_id: string, capture_time: string, camera_serial: string>>>"
CALIBRATION_RESULT = "task_type string, project_id int, camera_serial string, offset_seconds double, status string, match_count int, error string"

PARTICIPANTS = "project_id string, bib_number string, finish_time string"
PHOTOS = "id string, project_id string, photo_id int, file_path string, corrected_time double, camera_serial string, is_finish_line boolean, subject_count int, matched_count int, inference_ms double, status string, processed_at timestamp"
SUBJECTS = "id string, photo_id string, identity_id string, bbox_x double, bbox_y double, bbox_w double, bbox_h double, confidence double, area_pct double, face_quality double, ocr_bib string, ocr_confidence double, assigned_bib string, match_type string"
CAMERA_OFFSETS = "project_id string, camera_serial string, camera_model string, offset_seconds double, sample_count int, mad_seconds double, calibrated_at timestamp"
