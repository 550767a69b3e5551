from tablecraft.streaming.streams import *  # noqa: F401,F403
