"""Column-expression helpers; everything here stays on the JVM."""

from pagetables.functions.text import (  # noqa: F401
    PY_SPACE, py_strip, py_rstrip, unescape_entities, strip_tags,
    clean_content, is_digits, url_suffix, category_prefix, resolve_url,
    resolve_relative, url_path_segment, url_host, url_origin, collapse_space,
)
from pagetables.functions.vectors import (  # noqa: F401
    dot, norm, cosine, l2_normalize_expr,
)
