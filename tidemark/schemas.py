"""Fixed schemas, as DDL, of frames, events, depth updates, text items and run-level tables."""

FRAME = "source string, received_at timestamp, payload string"
LEVELS = "array<struct<price:double,size:double>>"
ASSET = "struct<symbol:string,asset_id:string,canonical_symbol:string,name:string>"
INSTRUMENT = f"struct<instrument_id:string,venue:string,venue_symbol:string,canonical_symbol:string,instrument_type:string,base_asset:{ASSET},quote_asset:{ASSET}>"
EVENT_META = "struct<instrument_id:string,canonical_symbol:string,buyer_is_maker:boolean,subscribe_replay:boolean,event_time:timestamp,parse_errors:array<string>,extra:map<string,string>>"
EVENT = f"source string, product string, channel string, event_type string, exchange_time timestamp, received_at timestamp, side string, price double, size double, order_id string, trade_id string, sequence bigint, raw_type string, metadata {EVENT_META}"
DEPTH_META = "struct<bybit_update_id:bigint,bybit_cross_sequence:bigint,kraken_checksum:bigint,okx_seq_id:bigint,okx_prev_seq_id:bigint,okx_checksum:bigint,mexc_version:bigint,parse_errors:array<string>,extra:map<string,string>>"
DEPTH = f"source string, product string, channel string, event_type string, event_time timestamp, received_at timestamp, first_update_id bigint, final_update_id bigint, instrument {INSTRUMENT}, bids {LEVELS}, asks {LEVELS}, metadata {DEPTH_META}"
TEXT_META = "struct<source_ts_raw:string,source_ts_unparseable:boolean,listing:string,poll:string,parse_errors:array<string>>"
TEXT = f"source string, product string, channel string, event_type string, source_id string, source_ts timestamp, ingestion_ts timestamp, received_at timestamp, content_hash string, raw_item string, metadata {TEXT_META}"
VERDICT_INDEX = "run_path string, promoted_at timestamp, promoted_rows bigint, replay_summary_path string"
METRICS = "raw_messages bigint, clean_events bigint, quarantined_events bigint, reject_counts map<string,bigint>, partial boolean"
SNAPSHOT = "source string, product string, received_at timestamp, snapshot struct<lastUpdateId:bigint,bids:array<array<string>>,asks:array<array<string>>>"
