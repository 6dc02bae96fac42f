"""Production parameters of the registered queries."""

BPE_FILE = "byte_bpe_multi_50k.tiktoken"
LM_FILE = "piece_bpe_32k.model"
# sixteen shards; the last four have twice the room
SHARDS = {f"shard-{i:02d}": 1 + (i >= 12) for i in range(16)}
