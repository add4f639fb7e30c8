"""Output texts that must equal the reference's results.

Kept together, as plain text, in the order the reference uses them.
"""

# Route tags of the split stream and the two co-map outputs.
TAG_HIGH = "high"
TAG_LOW = "low"
MSG_HIGH = "high temp warning"
MSG_LOW = "normal"

# Cogroup text block: a header per input, then one "key=>value" line per item.
COGROUP_HEADER_LEFT = "input stream 1: \n"
COGROUP_HEADER_RIGHT = "input stream 2: \n"
COGROUP_ITEM_SEP = "=>"

# Window-join output: left value, one space, right value.
JOIN_TEXT_SEP = " "

# Continuous-rise alarm: these, with the key after the first and the seconds after the second.
ALERT_SENSOR = "传感器"
ALERT_RISING = "温度值连续"
ALERT_ROSE = "s上升"
