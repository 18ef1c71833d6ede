"""Schemas of the datasets, as DDL; nothing is inferred."""

CAMPS = "camp string, label string, win_start date, win_end date"
ROSTER = "canonical_id string, camp string, dir_name string, title string, instructor string, case_series boolean"
GOODS = "goods_id string, goods_name string, resource_type int, price_low double, sell_num long, sale_status int, created_at string"
LIVES = "live_id string, title string, zb_start_at string, zb_stop_at string, alive_state int"
LEARNING = "goods_id string, user_id string, is_finish int"
BLOCKS = "course_id string, block_idx long, speaker string, start_sec double, text string"
TERMS = "canonical string, variants array<string>, category string, source string, note string"
GUARDS = "variant string, block_prev array<string>, block_next array<string>, note string"
NUMBER_RULES = "pattern string, unit string, context string"
REVIEW_EXCLUDE = "canonical string, variant string, reason string"
CARDS = "card_id string, course_id string, camp string, instructor string, type string, content string, quote string, start_sec double, end_sec double, review_status string"
FRAMES = "frame_id string, course_id string, camp string, timestamp_sec double, phash string, vision_label string, vision_confidence double, path string"
CHUNKS = "chunk_id string, course_id string, camp string, instructor string, title string, start_sec double, end_sec double, strategy string, text string"
VECTORS = "chunk_id string, embedding array<float>"
QUESTIONS = "qid string, course_id string, stem string, options map<string,string>, answer string, explanation string, source_card_ids array<string>, distractor_source array<string>, distractor_note string"
HANDOUTS = "course_id string, markdown string"
LEDGER = "ts timestamp, part string, model string, input_tokens long, output_tokens long, cached boolean"
PRICES = "model string, input double, output double, source string, note string"
CACHE = "key string, reply string"
