"""Domains and table schemas."""

from __future__ import annotations

OK, RECOVERED, FLAGGED, FAILED = "ok", "recovered", "flagged", "failed"
GOOD = (OK, RECOVERED)
BAD = (FLAGGED, FAILED)
TRANSPARENT, WHITE_BG, COMPLEX_BG = "transparent", "white_bg", "complex_bg"
IMAGE_EXTENSIONS = ("tif", "tiff", "png", "jpg", "jpeg", "bmp", "webp")

#: Flag codes and what they tell the reviewer.
FLAG_DESCRIPTIONS = {
    "no_object_found": "No product object detected in image",
    "mask_too_small": "Detected object mask is suspiciously small",
    "mask_too_fragmented": "Object mask is too fragmented to crop reliably",
    "bbox_too_large": "Bounding box covers suspiciously large portion of image",
    "bbox_too_small": "Bounding box is suspiciously small",
    "crop_category_inconsistent": "Crop result inconsistent with category expectations",
    "object_too_close_to_edge": "Object is too close to canvas edge after placement",
    "multiple_large_components": "Multiple similarly-sized components detected",
    "fill_ratio_too_low": "Object fills too little of the final canvas",
    "fill_ratio_too_high": "Object fills too much of the final canvas",
    "missing_mapping": "No mapping entry found for this supplier SKU",
    "image_read_error": "Failed to read or decode image file",
    "naming_conflict": "Output filename conflicts with another image",
}

MAPPING_REQUIRED = ("supplier_sku", "store_article", "suffix", "category")
MAPPING_OPTIONAL = ("variant", "color", "angle", "notes")

BOX = "struct<x:int,y:int,w:int,h:int>"
METRICS = f"struct<fill_ratio:double,crop_area_ratio:double,margin_px:int,object_bbox:{BOX},crop_bbox:{BOX},object_pixel_count:long,component_count:int>"
RESULTS = f"name string, source_path string, status string, category string, flags array<string>, proposed_filenames array<string>, output_names array<string>, background_type string, source_width int, source_height int, source_size_bytes long, crop_metrics {METRICS}, fallback_metrics {METRICS}, processing_time_s double, crop_time_s double, fallback_time_s double, fallback_attempted boolean, error_message string, seq long"
RESULT_JSON = "struct<status:string,category:string,flags:array<string>,fallback_attempted:boolean,fill_ratio:double,crop_area_ratio:double,component_count:int,background_type:string>"

#: An image that a run has handled.
DONE = "name string, status string, outputs array<string>, flags array<string>"
