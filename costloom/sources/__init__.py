from costloom.sources.store import Store  # noqa: F401
from costloom.sources.templates import MANIFEST, Template, clean_headers, read_template  # noqa: F401
