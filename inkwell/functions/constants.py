"""Fixed values."""

MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")

#: Stop words that lexical statistics leave out, and the further ones that term weighting leaves out.
STOP_WORDS = tuple(
    """the be to of and a in that have i it for not on with he as you do at this but his by from they we say her she or an
    will my one all would there their what so up out if about who get which go me when make can like time no just him know
    take people into year your good some could them see other than then now look only come its over think also back after
    use two how our work first well way even new want because any these give day most us was were had has been""".split()
)
MORE_STOP_WORDS = tuple("is are am being more very much really thing things lot bit".split())
ALL_STOP_WORDS = STOP_WORDS + MORE_STOP_WORDS

#: A small sentiment lexicon of our own; callers may pass a larger table.
SENTIMENT = {"good": 3, "great": 3, "love": 3, "best": 3, "happy": 3, "nice": 3, "win": 4, "bad": -3, "worst": -3, "hate": -3, "sad": -2, "fail": -2, "stupid": -2, "trash": -2, "idiot": -3, "loser": -3, "pathetic": -2, "disgusting": -3, "worthless": -2, "moron": -3, "scum": -3}
NEGATIONS = ("not", "no", "never", "neither", "nor", "cannot")
