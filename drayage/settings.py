"""Fixed values of the transfer rules; results depend on them."""

DEFAULT_CHUNK_SIZE = 26_214_400      # 25 MiB
MIN_UPLOAD_CHUNK_SIZE = 5_242_880    # 5 MiB
MAX_TRIES = 6                        # a try starts at byte 0 of the chunk
MAX_RESPONSES_PER_TRY = 10           # an incomplete response is resumed
MAX_UPLOAD_PARTS = 10_000
STALE_AFTER_DAYS = 7
STORAGE_CLASSES = ("STANDARD", "REDUCED_REDUNDANCY")

# Unfinished multipart bodies live here, below the target root, and listings can leave them out.
STAGING_DIR = ".uploads"


def effective_chunk_size(requested=None, direction="download"):
    """Chunk size to use for a requested one, which may be text, missing or out of range.

    Uploads below the minimum and anything that is not a number get the default. Downloads have no minimum.
    """
    if requested is None:
        return DEFAULT_CHUNK_SIZE
    try:
        size = int(requested)
    except (TypeError, ValueError):
        return DEFAULT_CHUNK_SIZE
    if direction == "upload" and size < MIN_UPLOAD_CHUNK_SIZE:
        return DEFAULT_CHUNK_SIZE
    if size <= 0:
        raise ValueError("a chunk needs at least one byte")
    return size


def check_direction(direction):
    if direction not in ("download", "upload"):
        raise ValueError(f"direction is 'download' or 'upload', not {direction!r}")
    return direction
