"""postlake: archives of short posts on Spark."""

from postlake.operators.corpus import corpus_diff, corpus_diff_counts, render_body
from postlake.operators.decode import decode_items
from postlake.operators.dedupe import dedupe_last
from postlake.operators.filters import filter_contains, filter_kind, filter_min
from postlake.operators.hybrid import fuse_rankings, hybrid_search, search_all, search_with_fallback
from postlake.operators.incremental import (
    change_totals,
    classify_changes,
    gap_check,
    judge_batch,
    judged_report,
    late_filter,
    plan_update,
    update_report,
    upsert,
)
from postlake.operators.joins import boundary_seen, enrich_hits, join_hits, lookup_ids
from postlake.operators.markup import strip_markup
from postlake.operators.quality import archive_check
from postlake.operators.queries import query_units
from postlake.operators.ranking import recent, top, topk
from postlake.operators.rows import to_json_rows
from postlake.operators.search import search, search_posts, search_units
from postlake.operators.sql import register_views, run_sql
from postlake.operators.stats import (
    archive_latest,
    archive_stats,
    archive_summary,
    batch_summary,
    change_counts,
)
from postlake.operators.textindex import (
    TextIndex,
    build_index,
    build_postings,
    changed_posts,
    doc_stats,
    index_changes,
    index_totals,
    live_postings,
    merge_segments,
    published_segments,
    read_index,
    refresh_postings,
    term_stats,
    tokenize,
    write_index,
    write_segment,
)
from postlake.operators.vectors import vector_scores, vector_search
from postlake.schemas import CORPUS, POSTINGS, POSTS, UNITS
from postlake.session import build_session, stage
from postlake.sources.archive import read_posts, read_posts_near, write_changes, write_posts
from postlake.sources.corpus import parse_documents, read_corpus, read_rendered, write_corpus, write_corpus_changes
from postlake.sources.dumps import read_raw_items
from postlake.streaming.ingest import batch_ingest, daily_update, stream_ingest
