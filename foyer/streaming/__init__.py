"""Running streams: settings, triggers, sinks and keyed state with a timeout."""
