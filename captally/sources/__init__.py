"""Readers: caption CSV/TSV, split manifest, image folders, COCO JSON (SRC-1..7)."""

from captally.sources.captions import lower_header, parse_token_lines, read_caption_tokens, read_captions  # noqa: F401
from captally.sources.coco import read_coco_images, read_coco_predictions, read_coco_references  # noqa: F401
from captally.sources.images import scan_images, validate_images  # noqa: F401
from captally.sources.manifest import MANIFEST_SCHEMA, manifest_rows, raw_references, read_split_manifest  # noqa: F401
