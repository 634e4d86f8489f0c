from .incremental import checkpoint_for, flatten_new_files, flatten_stream

__all__ = ["checkpoint_for", "flatten_new_files", "flatten_stream"]
