from .changes import ChangeTable, dedupe_stream  # noqa: F401
