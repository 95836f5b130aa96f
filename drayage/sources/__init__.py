from .fastq import quarantined, read_fastq, read_fastq_objects, valid_records, with_read_ids
from .files import FileRanges
from .listing import list_objects, listing_errors, objects_of, walk
from .pages import BucketPages, list_pages
from .ranges import file_digests, read_ranges, slice_bodies
from .tables import head_objects, objects_from_table, read_path_list

__all__ = ["BucketPages", "FileRanges", "file_digests", "head_objects", "list_objects", "list_pages", "listing_errors", "objects_from_table", "objects_of",
           "quarantined", "read_fastq", "read_fastq_objects", "read_path_list", "read_ranges", "slice_bodies",
           "valid_records", "walk", "with_read_ids"]
