"""Word lists and weights of the content rules, as data."""

# These lists, their order and weights decide scores and the order of reasons.
THREATS = ("kill yourself", "i will kill you", "i'll kill you", "you should die", "you deserve to die", "hope you die", "go die", "i will hurt you", "i'll hurt you", "nobody would miss you")
INSULTS = ("idiot", "idiots", "stupid", "moron", "morons", "imbecile", "dumbass", "loser", "losers", "pathetic", "worthless", "retard", "retarded", "scum", "shut up", "you suck")
PROFANITY = ("fuck", "fucking", "fucked", "fucker", "motherfucker", "shit", "shitty", "bullshit", "bitch", "bastard", "asshole", "dickhead", "cunt", "damn you")
GROUPS = ("women", "men", "girls", "boys", "females", "males", "muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "atheists", "immigrants", "refugees", "migrants", "foreigners", "black people", "blacks", "white people", "whites", "asians", "africans", "arabs", "latinos", "hispanics", "mexicans", "indians", "chinese", "gays", "gay people", "lesbians", "trans people", "transgender people", "old people", "elderly people", "the elderly", "disabled people", "poor people")
COPULAS = ("are", "is", "can't", "cannot", "can", "should", "shouldn't", "tend", "will", "won't", "don't", "never", "always", "lack", "belong", "make")
STRONG = ("inferior", "superior", "subhuman", "criminals", "criminal", "terrorists", "animals", "savages", "parasites", "vermin", "inherently", "dangerous", "violent", "lazy", "stupid", "dumb", "incapable", "untrustworthy", "dirty", "primitive", "less intelligent", "can't be trusted", "cannot be trusted")
WEAK = ("always", "never", "naturally", "typically", "bad at", "better at", "worse at", "too emotional", "emotional", "belong in", "shouldn't be allowed", "should not be allowed", "not capable")
PREFIXES = ("all", "every", "most")
ATTRIBUTIONS = ("studies show", "studies have shown", "research shows", "research has shown", "experts agree", "scientists agree", "according to a recent study", "according to a study", "according to research", "statistics show", "it is a well known fact", "it's a well known fact", "it is widely known", "sources say")
CUTOFFS = ("my knowledge cutoff", "my training data", "as of my last update", "i don't have access to real time", "i do not have access to real time", "i cannot browse", "i can't browse")
CORRECTIONS = ("i apologize for the confusion", "apologies for the confusion", "i was mistaken", "i made an error", "let me correct")
HEDGES = ("i think", "i believe", "probably", "possibly", "might", "perhaps", "i'm not sure", "i am not sure", "not certain", "as far as i know", "if i recall", "i guess")

CATEGORIES = ("hallucination", "toxicity", "bias", "anomaly")
#: category, rule, weight and phrases of the rules that fire once for each phrase.
PHRASE_RULES = (
    ("toxicity", "threat", 0.60, THREATS), ("toxicity", "insult", 0.35, INSULTS), ("toxicity", "profanity", 0.25, PROFANITY),
    ("hallucination", "unsupported_attribution", 0.20, ATTRIBUTIONS), ("hallucination", "knowledge_cutoff", 0.20, CUTOFFS), ("hallucination", "self_correction", 0.15, CORRECTIONS),
)
CUSTOM_WEIGHT, SHOUTING_WEIGHT, STRONG_WEIGHT, WEAK_WEIGHT = 0.50, 0.20, 0.55, 0.35
#: Finish reasons by what they are called elsewhere.
FINISH = {"max_tokens": "length", "max_output_tokens": "length", "end_turn": "stop", "stop_sequence": "stop", "tool_use": "tool_calls", "TASK_STATE_COMPLETED": "stop", "completed": "stop", "TASK_STATE_INPUT_REQUIRED": "stop", "input-required": "stop", "TASK_STATE_FAILED": "failed", "failed": "failed", "TASK_STATE_REJECTED": "failed", "rejected": "failed"}
NOTICE = "This response was withheld because it did not meet output quality requirements."
SEND_METHODS = ("message/send", "message/stream", "SendMessage", "SendStreamingMessage")
