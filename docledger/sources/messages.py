"""What diagnostics say, by what they are about. Their codes and severities stand where they are raised."""

#: Of packages.
CRC = "the bytes of {} do not match their checksum"
DUPLICATE = "this name stands more than once in the archive"
NO_TYPES = "nothing declares the content types of the parts"
TYPES_ROOT = "the list of content types begins with another element than Types"
RELATIONSHIPS_ROOT = "a list of relationships begins with another element than Relationships"
ABSENT_TARGET = "no part is named {}"
NOT_SANITIZED = "findings are reported only; the file is left as it came"
NO_PART = "no part is named {}"

#: Of targets.
BAD_CHARACTERS = "a target must not be empty or hold NUL or a backslash"
ABSOLUTE = "a target inside the package must be relative"
NO_PATH = "the target names no part"
ESCAPES = "the target escapes package boundaries"
ROOT = "the target is the package itself"

#: Of parts and elements.
ABSENT_PART = "{} was asked for but is not there"
UNPARSED = "{} is no readable XML: {}"
NO_BODY = "the main part holds no body"
BLOCK = "no rule for {} among blocks"
INLINE = "no rule for {} within a paragraph"
DRAWING = "the drawing shows no image, chart or text box that can be read"
VML = "the VML picture shows no image or text box"
ALTERNATE = "none of the alternatives can be read"
IMAGE = "the image {!r} leads nowhere"
NO_IMAGE_RELATIONSHIP = "the image names no relationship"
UNRESOLVED = "{} leads nowhere"
NO_LATEX = "nothing of the equation could be written as LaTeX"

#: Of charts.
CHART_UNDECLARED = "the part that shows the chart has no such relationship"
CHART_TYPE = "the relationship is not of a chart"
CHART_EXTERNAL = "the chart lies outside the package and was not looked for"
CHART_UNRESOLVED = "the chart's part is not there"
CHART_ROOT = "the chart's part begins with another element than chartSpace"
BOOK_UNNAMED = "the chart's data names no relationship"
BOOK_EXTERNAL = "the workbook lies outside the package and was not looked for"
BOOK_UNRESOLVED = "the workbook's part is not there"
BOOK_TYPE = "the chart's data is of another type than a workbook"
