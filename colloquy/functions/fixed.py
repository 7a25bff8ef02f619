"""Fixed values of the chat format. They must be exactly these for prompts to be right."""

# Added tokens with their ids; the first 14 are "special".
FIRST_TOKEN_ID = 151643
SPECIAL_TOKENS = [
    "<|endoftext|>",
    "<|im_start|>",
    "<|im_end|>",
    "<|object_ref_start|>",
    "<|object_ref_end|>",
    "<|box_start|>",
    "<|box_end|>",
    "<|quad_start|>",
    "<|quad_end|>",
    "<|vision_start|>",
    "<|vision_end|>",
    "<|vision_pad|>",
    "<|image_pad|>",
    "<|video_pad|>",
]
PLAIN_TOKENS = [
    "<tool_call>",
    "</tool_call>",
    "<|fim_prefix|>",
    "<|fim_middle|>",
    "<|fim_suffix|>",
    "<|fim_pad|>",
    "<|repo_name|>",
    "<|file_sep|>",
    "<tool_response>",
    "</tool_response>",
    "<think>",
    "</think>",
]
ADDED_TOKENS = SPECIAL_TOKENS + PLAIN_TOKENS
END_OF_TEXT = "<|endoftext|>"
END_OF_THINKING_ID = 151668

# The text around a list of tools.
TOOLS_INTRO = (
    "# Tools\n\n"
    "You may call one or more functions to assist with the user query.\n\n"
    "You are provided with function signatures within <tools></tools> XML tags:\n"
    "<tools>"
)
TOOLS_OUTRO = (
    "\n</tools>\n\n"
    "For each function call, return a json object with function name and arguments "
    "within <tool_call></tool_call> XML tags:\n"
    "<tool_call>\n"
    '{"name": <function-name>, "arguments": <args-json-object>}\n'
    "</tool_call>"
)
EMPTY_THINKING = "<think>\n\n</think>\n\n"

# Defaults of one answer.
DEFAULT_SYSTEM_PROMPT = "你是一个有帮助的AI助手。"
DEFAULT_MAX_LENGTH = 512
DEFAULT_TEMPERATURE = 0.7
DEFAULT_TOP_P = 0.9
DEFAULT_DO_SAMPLE = True
REPETITION_PENALTY = 1.1

# Words that end a chat.
EXIT_WORDS = ["quit", "exit", "退出"]

# Length limits in tokens (context, positions, tokenizer, suggested outputs).
CONTEXT_LENGTH = 32768
POSITION_LIMIT = 40960
TOKENIZER_LIMIT = 131072
OUTPUT_LENGTH = 32768
HARD_OUTPUT_LENGTH = 38912

# Sampling settings per mode (mode, temperature, top_p, top_k, min_p).
SAMPLING_PRESETS = [
    ("thinking", 0.6, 0.95, 20, 0.0),
    ("non_thinking", 0.7, 0.8, 20, 0.0),
]

# Temperatures of a sweep.
SWEEP = [("low", 0.1), ("medium", 0.7), ("high", 1.0)]

# Answer-format instructions per task.
TASK_INSTRUCTIONS = {
    "math": "Please reason step by step, and put your final answer within \\boxed{}.",
    "choice": (
        "Please show your choice in the `answer` field with only the choice letter, "
        'e.g., `"answer": "C"`.'
    ),
}

# The five smoke cases (name, input, type, params).
SMOKE_CASES = [
    ("基础问答测试", "你好，请介绍一下你自己。", "chat", None),
    ("知识问答测试", "什么是机器学习？", "chat", None),
    ("代码生成测试", "请用Python写一个计算斐波那契数列的函数。", "chat", None),
    ("创意写作测试", "请写一首关于春天的短诗。", "chat", None),
    (
        "文本补全测试",
        "人工智能的未来发展趋势是",
        "generate",
        {"max_length": 200.0, "temperature": 0.8},
    ),
]

# The characters that Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
