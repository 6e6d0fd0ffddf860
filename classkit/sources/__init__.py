from classkit.sources.tables import (  # noqa: F401
    explode_features,
    pack_features,
    preview,
    read_table,
    write_table,
)
