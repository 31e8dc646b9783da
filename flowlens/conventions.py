"""Names, limits and lists that stored tables and reports depend on.

Everything here is data. Functions elsewhere take these as default arguments, so another dataset
only needs other arguments.
"""

# --- column names of the stored tables (fixed values) ---
LABEL = "label"
LABEL_INDEX = "label_index"
FEATURES_VECTOR = "features"
SCALED_VECTOR = "scaled_features"
CLASS_WEIGHT = "class_weight"
SOURCE_FILE = "_source_file"
SPLIT = "_split"
CLUSTER = "cluster_id"
SCORE = "distancia_centroide"
FLAG = "prediccion_binaria"
TRUTH = "label_binaria"
PREDICTION = "prediction"
PROBABILITY = "probability"

TRAIN_COLUMNS = [LABEL, LABEL_INDEX, FEATURES_VECTOR, SCALED_VECTOR, CLASS_WEIGHT, SOURCE_FILE, SPLIT]
TEST_COLUMNS = [LABEL, LABEL_INDEX, FEATURES_VECTOR, SCALED_VECTOR, SOURCE_FILE, SPLIT]
FOREST_SCORE_COLUMNS = [LABEL, LABEL_INDEX, PREDICTION, FLAG, TRUTH, PROBABILITY]
CLUSTER_SCORE_COLUMNS = [SCORE, CLUSTER, FLAG, TRUTH, LABEL_INDEX]

# --- columns that never become features (fixed values) ---
NON_FEATURES = [
    "label", "_source_file", "_split", "label_index", "class_weight", "features", "scaled_features",
    "timestamp", "flow_id", "src_ip", "src_port", "dst_ip", "dst_port",
]

# --- the 78 features of the wire format, alphabetical (fixed values) ---
WIRE_FEATURES = """
ack_flag_count act_data_pkt_fwd active_max active_mean active_min active_std average_packet_size
avg_bwd_segment_size avg_fwd_segment_size bwd_avg_bulk_rate bwd_avg_bytesbulk bwd_avg_packetsbulk
bwd_header_length bwd_iat_max bwd_iat_mean bwd_iat_min bwd_iat_std bwd_iat_total
bwd_packet_length_max bwd_packet_length_mean bwd_packet_length_min bwd_packet_length_std
bwd_packetss bwd_psh_flags bwd_urg_flags cwe_flag_count destination_port downup_ratio
ece_flag_count fin_flag_count flow_bytess flow_duration flow_iat_max flow_iat_mean flow_iat_min
flow_iat_std flow_packetss fwd_avg_bulk_rate fwd_avg_bytesbulk fwd_avg_packetsbulk
fwd_header_length34 fwd_header_length55 fwd_iat_max fwd_iat_mean fwd_iat_min fwd_iat_std
fwd_iat_total fwd_packet_length_max fwd_packet_length_mean fwd_packet_length_min
fwd_packet_length_std fwd_packetss fwd_psh_flags fwd_urg_flags idle_max idle_mean idle_min idle_std
init_win_bytes_backward init_win_bytes_forward max_packet_length min_packet_length
min_seg_size_forward packet_length_mean packet_length_std packet_length_variance psh_flag_count
rst_flag_count subflow_bwd_bytes subflow_bwd_packets subflow_fwd_bytes subflow_fwd_packets
syn_flag_count total_backward_packets total_fwd_packets total_length_of_bwd_packets
total_length_of_fwd_packets urg_flag_count
""".split()

# --- abbreviated column name -> feature name, 45 pairs (fixed values) ---
HOMOLOGATION = {
    "flow_byts_s": "flow_bytes_s",
    "flow_pkts_s": "flow_packets_s",
    "fwd_pkts_s": "fwd_packets_s",
    "bwd_pkts_s": "bwd_packets_s",
    "fwd_pkt_len_max": "fwd_packet_length_max",
    "fwd_pkt_len_min": "fwd_packet_length_min",
    "fwd_pkt_len_mean": "fwd_packet_length_mean",
    "fwd_pkt_len_std": "fwd_packet_length_std",
    "bwd_pkt_len_max": "bwd_packet_length_max",
    "bwd_pkt_len_min": "bwd_packet_length_min",
    "bwd_pkt_len_mean": "bwd_packet_length_mean",
    "bwd_pkt_len_std": "bwd_packet_length_std",
    "pkt_len_max": "max_packet_length",
    "pkt_len_min": "min_packet_length",
    "pkt_len_mean": "packet_length_mean",
    "pkt_len_std": "packet_length_std",
    "pkt_len_var": "packet_length_variance",
    "pkt_size_avg": "average_packet_size",
    "fwd_seg_size_avg": "avg_fwd_segment_size",
    "bwd_seg_size_avg": "avg_bwd_segment_size",
    "fwd_seg_size_min": "min_seg_size_forward",
    "fwd_byts_b_avg": "fwd_avg_bytes_bulk",
    "fwd_pkts_b_avg": "fwd_avg_packets_bulk",
    "fwd_blk_rate_avg": "fwd_avg_bulk_rate",
    "bwd_byts_b_avg": "bwd_avg_bytes_bulk",
    "bwd_pkts_b_avg": "bwd_avg_packets_bulk",
    "bwd_blk_rate_avg": "bwd_avg_bulk_rate",
    "fin_flag_cnt": "fin_flag_count",
    "syn_flag_cnt": "syn_flag_count",
    "rst_flag_cnt": "rst_flag_count",
    "psh_flag_cnt": "psh_flag_count",
    "ack_flag_cnt": "ack_flag_count",
    "urg_flag_cnt": "urg_flag_count",
    "ece_flag_cnt": "ece_flag_count",
    "tot_fwd_pkts": "total_fwd_packets",
    "tot_bwd_pkts": "total_backward_packets",
    "totlen_fwd_pkts": "total_length_of_fwd_packets",
    "totlen_bwd_pkts": "total_length_of_bwd_packets",
    "subflow_fwd_pkts": "subflow_fwd_packets",
    "subflow_bwd_pkts": "subflow_bwd_packets",
    "subflow_fwd_byts": "subflow_fwd_bytes",
    "subflow_bwd_byts": "subflow_bwd_bytes",
    "init_bwd_win_byts": "init_win_bytes_backward",
    "init_fwd_win_byts": "init_win_bytes_forward",
    "fwd_act_data_pkts": "act_data_pkt_fwd",
}

# --- weekday -> split, in the order the weekdays are tried (fixed values) ---
SPLIT_BY_DAY = {
    "monday": "train",
    "tuesday": "test",
    "wednesday": "train",
    "thursday": "test",
    "friday": "train",
}

# --- cleaning and sampling (fixed values) ---
LOSS_LIMIT = 0.30
SEARCH_FRACTION = 0.30
SEED = 42

# --- threshold calibration (fixed values) ---
QUANTILES = (0.90, 0.95, 0.97, 0.99, 0.999)
QUANTILE_ERROR = 0.001
GRID_POINTS = 20
UNSEEN_PATTERNS = ("web attack", "infiltration")
FULL_DETECTION = 0.5

# --- model parameters and search grids (fixed values) ---
FOREST = {"trees": 100, "depth": 10, "subset": "sqrt"}
FOREST_GRID = {"trees": [50, 100, 200], "depth": [5, 10, 15], "subset": ["sqrt", "log2"]}
FOREST_FOLDS = 3
CLUSTERS = {"k": 10, "max_iter": 50, "tol": 1e-4}
CLUSTER_GRID = [
    {"k": 5, "max_iter": 20, "tol": 1e-4},
    {"k": 10, "max_iter": 20, "tol": 1e-4},
    {"k": 15, "max_iter": 20, "tol": 1e-4},
    {"k": 20, "max_iter": 50, "tol": 1e-4},
    {"k": 30, "max_iter": 50, "tol": 1e-4},
    {"k": 10, "max_iter": 50, "tol": 1e-5},
    {"k": 15, "max_iter": 50, "tol": 1e-5},
    {"k": 20, "max_iter": 50, "tol": 1e-5},
]
SILHOUETTE_TIE = 0.01
TOP_FEATURES = 15

# --- streaming and service levels (fixed values) ---
TRIGGER = "10 seconds"
STREAM_THRESHOLD = 15.0
SLA_STATES = [  # state, latency above (ms), or throughput ratio below
    ("VIOLATION", 60_000, 1.0),
    ("CRITICAL", 35_000, 1.1),
    ("WARNING", 22_000, 1.2),
]
SLA_TARGETS = {"p50": 12_000, "p95": 22_000, "max": 60_000}
SLA_PERCENTILES = (50, 95, 99)
SLA_HISTORY_KEPT = 30
SLA_HISTORY_SHOWN = 8
