"""Sources and sinks."""

from linkgraph.sources.readers import create_schema, read_by_prefix, read_file, read_kinds, read_table, read_whole_files, to_ddl  # noqa: F401
from linkgraph.sources.sinks import (  # noqa: F401
    import_manifest,
    join_parts,
    read_export,
    save_file,
    save_header,
    staged_export,
    write_edges,
    write_manifest,
    write_nodes,
)
