from .accounting import (attempt_accounting, complete_manifest, manifest_parts, node_summary, object_digests, reassemble,
                         reassemble_blocks, throughput, transfer_summary, verify_transfer)
from .joins import bind_targets, incomplete_uploads, remaining_ranges
from .keys import attach_metadata, filter_prefix, map_download_targets, map_upload_keys, parse_object_uri
from .maintenance import clean_parts, list_uploads, stale_uploads
from .records import fastq_boundaries, fastq_split, locate_boundaries, pair_mates
from .store_parts import commit_parts, copy_parts
from .transfer import (CopyResult, TransferFailed, copy_multipart, copy_objects, copy_plan, finished_chunks,
                       publish_copies, write_objects, write_split)

__all__ = ["CopyResult", "TransferFailed", "attach_metadata", "attempt_accounting", "bind_targets", "clean_parts",
           "commit_parts", "complete_manifest", "copy_multipart", "copy_objects", "copy_parts", "copy_plan", "fastq_boundaries", "fastq_split",
           "filter_prefix", "finished_chunks", "incomplete_uploads", "list_uploads", "locate_boundaries",
           "manifest_parts", "map_download_targets", "map_upload_keys", "node_summary", "object_digests", "pair_mates", "parse_object_uri",
           "publish_copies", "reassemble", "reassemble_blocks", "remaining_ranges", "stale_uploads", "throughput", "transfer_summary",
           "verify_transfer", "write_objects", "write_split"]
