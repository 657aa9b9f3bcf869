from . import jsontext, paths, scores, text  # noqa: F401
