"""

``tests/test_coverage.py`` imports every entry, so a renamed or removed
function shows up as a failing test.
"""

COVERAGE: dict[str, list[str]] = {
    # 2.1 scans and sources
    "S1": ["tessera.sources.text.read_delimited", "tessera.sources.text.register_delimited"],
    "S2": ["tessera.sources.text.from_rows"],
    "S3": ["tessera.sources.text.read_lines", "tessera.sources.lines.numbered_lines"],
    "S4": ["tessera.sources.text.number_range"],
    "S5": ["tessera.sources.files.list_tree", "tessera.operators.manifest.with_parent_chains",
           "tessera.sources.files.refresh_tree"],
    "S6": ["tessera.sources.text.read_whole_files", "tessera.sources.text.read_file_texts"],
    "S7": ["tessera.sources.text.read_headers"],
    "S8": ["tessera.sources.text.read_lines", "tessera.operators.manifest.glob_entries",
           "tessera.operators.patterns.match_patterns"],
    # 2.2 sinks
    "K1": ["tessera.sinks.text.write_key_values"],
    "K2": ["tessera.sinks.text.compact_text", "tessera.operators.ranges.merge_in_order"],
    "K3": ["tessera.operators.copy.copy_tree", "tessera.operators.copy.run_copy",
           "tessera.operators.copy.balanced_file_tasks", "tessera.operators.copy.left_to_copy",
           "tessera.operators.ranges.copy_ranges"],
    "K4": ["tessera.operators.copy.copy_summary"],
    # 2.3 projections, filters, predicates
    "P1": ["tessera.operators.relational.average_rating_by"],
    "P2": ["tessera.operators.relational.top_titles"],
    "P3": ["tessera.operators.relational.stacked_range_filter"],
    "P4": ["tessera.operators.relational.computed_columns", "tessera.sources.text.number_range"],
    "P5": ["tessera.functions.parse.not_blank"],
    "P6": ["tessera.functions.parse.split_fields", "tessera.operators.traffic.parse_traffic"],
    "P7": ["tessera.functions.parse.strict_int"],
    "P8": ["tessera.functions.paths.rebase_path", "tessera.operators.manifest.rebase"],
    "P9": ["tessera.operators.manifest.name_contains", "tessera.operators.manifest.siblings",
           "tessera.operators.manifest.inside"],
    "P10": ["tessera.operators.manifest.any_match", "tessera.operators.manifest.any_glob_match",
            "tessera.operators.patterns.match_patterns"],
    "P11": ["tessera.operators.manifest.copy_work"],
    # 2.4 row-expanding
    "X1": ["tessera.operators.text_index.term_counts"],
    "X2": ["tessera.functions.paths.parent_chain", "tessera.operators.manifest.with_parent_folders"],
    # 2.5 joins
    "J1": ["tessera.operators.relational.average_rating_by"],
    "J2": ["tessera.operators.relational.top_titles"],
    "J3": ["tessera.operators.relational.top_titles_of_top_user"],
    "J4": ["tessera.operators.manifest.copy_plan"],
    "J5": ["tessera.operators.relational.distinct_except"],
    # 2.6 aggregations
    "A1": ["tessera.operators.relational.average_rating_by"],
    "A2": ["tessera.operators.relational.top_titles"],
    "A3": ["tessera.operators.relational.top_user"],
    "A4": ["tessera.operators.traffic.traffic_totals"],
    "A5": ["tessera.operators.text_index.posting_lists"],
    "A6": ["tessera.operators.text_index.posting_lists", "tessera.operators.index_store.compact"],
    "A7": ["tessera.operators.text_index.term_counts"],
    "A8": ["tessera.operators.text_index.posting_lists_with_counts"],
    "A9": ["tessera.operators.relational.distinct_except"],
    "A10": ["tessera.operators.placement.batch_index"],
    "A11": ["tessera.operators.manifest.folder_sizes", "tessera.operators.manifest.path_sizes"],
    "A12": ["tessera.operators.manifest.file_sizes"],
    "A13": ["tessera.operators.manifest.entry_times", "tessera.operators.manifest.first_entry_time",
            "tessera.operators.manifest.path_first_times"],
    "A14": ["tessera.operators.manifest.name_lists", "tessera.operators.ranking.group_positions"],
    # 2.7 window-like
    "W1": ["tessera.operators.ranking.exclusive_prefix_sum", "tessera.operators.placement.batch_index"],
    "W2": ["tessera.operators.manifest.with_parent_folders"],
    # 2.8 sort, limit, top-k
    "O1": ["tessera.operators.relational.top_titles"],
    "O2": ["tessera.operators.relational.top_user"],
    # 2.9 set operators
    "U1": ["tessera.operators.relational.distinct_except"],
    "U2": ["tessera.operators.index_store.merge_indexes", "tessera.operators.text_index.merge_posting_lists"],
    # 2.11 keyed cells and work placement
    "C1": ["tessera.operators.cells.put_cells", "tessera.operators.cells.merge_cells",
           "tessera.operators.cell_buckets.put"],
    "C2": ["tessera.operators.cells.get_rows", "tessera.operators.cell_buckets.get"],
    "C3": ["tessera.operators.cells.delete_rows"],
    "R1": ["tessera.operators.placement.assign_slots", "tessera.operators.placement.place_by_slot",
           "tessera.operators.placement.slots_by_size"],
    "R2": ["tessera.operators.placement.spread"],
}
