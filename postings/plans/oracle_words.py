"""The stop words of the SQL texts. Plain values, so that the SQL needs neither Spark nor its files."""

# Spark's default lists of both languages, and the extra words of the analyses.
SWEDISH = """
    och det att i en jag hon som han på den med var sig för så till är men ett om hade de av
    icke mig du henne då sin nu har inte hans honom skulle hennes där min man ej vid kunde något
    från ut när efter upp vi dem vara vad över än dig kan sina här ha mot alla under någon eller
    allt mycket sedan ju denna själv detta åt utan varit hur ingen mitt ni bli blev oss din
    dessa några deras blir mina samma vilken er sådan vår blivit dess inom mellan sådant varför
    varje vilka ditt vem vilket sitta sådana vart dina vars vårt våra ert era vilkas
""".split()

ENGLISH = """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
    she her hers herself it its itself they them their theirs themselves what which who whom
    this that these those am is are was were be been being have has had having do does did doing
    a an the and but if or because as until while of at by for with about against between into
    through during before after above below to from up down in out on off over under again
    further then once here there when where why how all any both each few more most other some
    such no nor not only own same so than too very s t can will just don should now i'll you'll
    he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're
    they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't
    doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's
    how's let's ought that's there's what's when's where's who's why's would
""".split()

EXTRA = (
    "samt hos arbeta söker både vill kommer kommun län roll arbetsplats sök rekryteringsprocess "
    "arbete jobb jobba tjänsten arbetar ansökan får se ser enligt del krav"
).split()
